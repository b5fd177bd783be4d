"""Readers and writers of alignment, variant, evidence, region and reference files."""
