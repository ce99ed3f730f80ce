"""Column expressions: names, coordinates, checked arithmetic, gene regions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..contracts import BIN_BITS, COVERAGE_SUFFIXES, FASTA_SUFFIXES, GENOME_KEYS, I32_MAX, PRIORITY, STANDARD_CONTIGS, U32_MAX


def trimmed(c: Column) -> Column:
    """White space off; text that begins and ends with something else, as most
    does, is left at a glance."""
    tidy = (F.left(c, F.lit(1)) > " ") & (F.right(c, F.lit(1)) > " ")
    return F.when(tidy, c).otherwise(F.btrim(c, F.lit(" \t\n\x0b\x0c\r")))


def canonical_contig(c: Column) -> Column:
    """One leading "chr" or "CHR" off, upper case, M as MT. Only these two
    spellings are cut: "Chr1" becomes "CHR1"."""
    name = trimmed(c)
    bare = F.upper(F.when(F.left(name, F.lit(3)).isin("chr", "CHR"), F.substring(name, 4, I32_MAX)).otherwise(name))
    return F.when(bare == "M", "MT").otherwise(bare)


def sequence_of(text: Column) -> Column:
    """A text as a sequence: white space off, bases in capitals, U as T; any
    other letter stays. Null is empty."""
    return F.translate(F.coalesce(text, F.lit("")), "acgtunU \t\n\x0b\x0c\r", "ACGTTNT")


def is_standard_contig(c: Column) -> Column:
    return F.upper(F.regexp_replace(c, "(?i)^chr", "")).isin(*STANDARD_CONTIGS)


def f32(c: Column) -> Column:
    """To single precision by way of double, so that the optimizer keeps it."""
    return c.cast("double").cast("float")


def f32_ratio(a: Column, b: Column) -> Column:
    """Single-precision quotient of two counts, rounded once."""
    return (f32(a).cast("double") / f32(b).cast("double")).cast("float")


def beta_value(methylated: Column, total: Column) -> Column:
    return F.when(total > 0, f32_ratio(methylated, total))


def checked_u32(c: Column, what: str) -> Column:
    return F.when(c > U32_MAX, F.raise_error(F.lit(f"{what} exceeds the unsigned 32-bit range"))).otherwise(c)


def to_one_based(start: Column) -> Column:
    return start + 1


def width(start_one_based: Column, end: Column) -> Column:
    return end - start_one_based + 1


def saturating_add(c: Column, k: int) -> Column:
    return F.least(c + F.lit(k), F.lit(U32_MAX))


def saturating_sub(c: Column, k: int) -> Column:
    return F.greatest(c - F.lit(k), F.lit(0))


def signed_distance(pos: Column, tss: Column, strand: Column) -> Column:
    """Distance to the transcription start; upstream is negative."""
    return F.when(strand == "-", tss - pos).otherwise(pos - tss).cast("int")


def priority_of(annotation: Column) -> Column:
    return F.create_map(*[F.lit(x) for pair in PRIORITY.items() for x in pair])[annotation]


def rank_label(kind: str, i: Column, n: Column) -> Column:
    return F.format_string(f"{kind} %d of %d", i, n)


def _base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def _without_suffix(name: Column, suffixes: tuple[str, ...]) -> Column:
    """The first suffix that fits is cut."""
    out = name
    for suffix in reversed(suffixes):
        out = F.when(name.endswith(suffix), F.left(name, F.length(name) - len(suffix))).otherwise(out)
    return out


def sample_of(path: Column) -> Column:
    """The sample that a coverage file is of."""
    return _without_suffix(_base_name(path), COVERAGE_SUFFIXES)


def release_of(path: Column) -> Column:
    """The release that a FASTA file is of."""
    name = _base_name(path)
    bare = F.when(name.endswith(".gz"), F.left(name, F.length(name) - 3)).otherwise(name)
    found = _without_suffix(bare, FASTA_SUFFIXES)
    return F.when(found == "", "unknown").otherwise(found)


def genome_key_of(name: Column) -> Column:
    """The first known genome whose name occurs, else the name itself."""
    low = F.lower(_base_name(name))
    out = low
    for key in reversed(GENOME_KEYS):
        out = F.when(F.contains(low, F.lit(key)), key).otherwise(out)
    return out


def tsv_field(c: Column) -> Column:
    return F.translate(c, "\t\n\r", "   ")


def thousands(c: Column) -> Column:
    return F.format_number(c, 0)


def percent(count: Column, whole: Column) -> Column:
    return F.when(whole > 0, count.cast("double") * 100.0 / whole).otherwise(F.lit(0.0))


def bin_of(pos: Column) -> Column:
    return F.shiftright(pos, BIN_BITS)


def site_name(chr_: Column, start: Column) -> Column:
    return F.concat_ws(":", chr_, (start + 1).cast("string"))
