"""Names of samples, contigs and genome releases, on the driver."""

from __future__ import annotations

import os

from ..contracts import COVERAGE_SUFFIXES, FASTA_SUFFIXES, GENOME_KEYS, STANDARD_CONTIGS, CoverageError


def canonical_contig(name: str) -> str:
    bare = name.strip()
    if bare[:3] in ("chr", "CHR"):
        bare = bare[3:]
    bare = bare.upper()
    return "MT" if bare == "M" else bare


def is_standard_contig(name: str) -> bool:
    return (name[3:] if name[:3].lower() == "chr" else name).upper() in STANDARD_CONTIGS


def sample_name(path: str) -> str:
    """File name without the first coverage suffix that fits."""
    name = os.path.basename(path)
    for suffix in COVERAGE_SUFFIXES:
        if name.endswith(suffix):
            name = name[: -len(suffix)]
            break
    if not name:
        raise CoverageError(f"{path}: the file name leaves no sample name")
    return name


def sample_names(paths: list[str]) -> list[str]:
    names = [sample_name(p) for p in paths]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise CoverageError(f"duplicate sample names: {', '.join(twice)}")
    return names


def release_name(path: str) -> str:
    """File name without ".gz" and without a FASTA suffix."""
    name = os.path.basename(path)
    if name.endswith(".gz"):
        name = name[:-3]
    for suffix in FASTA_SUFFIXES:
        if name.endswith(suffix):
            name = name[: -len(suffix)]
            break
    return name or "unknown"


def genome_key(name: str) -> str:
    low = os.path.basename(name).lower()
    return next((k for k in GENOME_KEYS if k in low), low)


def thousands(n: int) -> str:
    return f"{n:,}"
