"""Engine configuration: frozen dataclasses filled from an optional TOML file."""

from __future__ import annotations

import dataclasses
import tomllib
from dataclasses import dataclass, field
from typing import Any


@dataclass(frozen=True)
class DepthSettings:
    """Which alignments count towards depth, how they are counted and in which windows."""

    min_mapq: int | None = 0
    min_unclipped: float | None = 0.6
    count_kind: str = "coverage"
    window_length: int = 100


@dataclass(frozen=True)
class ClusterSettings:
    """When two variant records belong to one cluster.

    The field defaults apply to presets that a TOML file gives only in part.
    """

    reciprocal_overlap: float = 0.8
    max_bp_distance: int | None = 300
    match_strands: bool = True
    match_sv_type: bool = True
    sv_type_out: str | None = None
    sample_overlap: float | None = 0.5


@dataclass(frozen=True)
class Config:
    """All settings with their defaults."""

    lib_estimation_sample_size: int = 100_000
    library_cutoff_deviation: float = 0.1
    library_cutoff_sd_mult: float = 7.0
    lib_estimation_sd_mult: float = 3.0
    sliding_window_margin: int = 200
    sliding_window_size: int = 10_000
    bloom_false_positive_rate: float = 0.0001
    bloom_expected_read_count: int = 100_000_000
    min_clipped_bases: int = 20
    supplementary_masked_as_secondary: bool = True
    htslib_io_threads: int = 0
    stdvcf_apply_filters: bool = True
    vcf_cluster_presets_per_tool_pesr: ClusterSettings = ClusterSettings(
        reciprocal_overlap=0.1, sample_overlap=None
    )
    vcf_cluster_presets_per_tool_doc: ClusterSettings = ClusterSettings(
        max_bp_distance=None, match_strands=False, match_sv_type=False, sv_type_out="CNV", sample_overlap=None
    )
    collect_doc_config: DepthSettings = field(default_factory=DepthSettings)
    annotate_read_evidence_max_dist: int = 1_000
    annotate_read_evidence_slack: int = 50
    blocked_regions_bed: str | None = None
    doc_annotation_min_bins: int = 10
    path_reference_fasta: str | None = None
    annotation_doc_baf_limit: int = 1_000_000


#: Sections of the TOML file that hold a table of their own.
_NESTED = {
    "vcf_cluster_presets_per_tool_pesr": ClusterSettings,
    "vcf_cluster_presets_per_tool_doc": ClusterSettings,
    "collect_doc_config": DepthSettings,
}


def _build(cls: type, values: dict[str, Any]) -> Any:
    known = {f.name for f in dataclasses.fields(cls)}
    return cls(**{k: v for k, v in values.items() if k in known})


def config_from_dict(values: dict[str, Any]) -> Config:
    """Build a :class:`Config`; unknown keys are ignored, absent keys keep their default."""
    values = dict(values)
    for name, cls in _NESTED.items():
        if isinstance(values.get(name), dict):
            values[name] = _build(cls, values[name])
    return _build(Config, values)


def load_config(path: str | None) -> Config:
    """Read a TOML file; without a path all defaults apply."""
    if path is None:
        return Config()
    with open(path, "rb") as handle:
        return config_from_dict(tomllib.load(handle))
