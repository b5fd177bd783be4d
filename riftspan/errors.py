"""Exceptions raised for invalid input, grouped under one base class."""


class RiftspanError(Exception):
    """Base class of all errors raised by the package."""


class MissingArgument(RiftspanError):
    """A required command line argument is absent."""


class InconsistentInput(RiftspanError):
    """Input files disagree, e.g. on their contig set."""


class OutputExists(RiftspanError):
    """The output path exists and overwriting was not allowed."""


class UnknownClusterSetting(RiftspanError):
    """The named clustering preset does not exist."""


class InvalidRegion(RiftspanError):
    """A region string is not of the form ``contig:start-end``."""


class InvalidPath(RiftspanError):
    """A path cannot be used."""


class InvalidBedFile(RiftspanError):
    """A BED line has too few fields or names an unknown contig."""


class MalformedRecord(RiftspanError):
    """An alignment or variant file violates its format."""
