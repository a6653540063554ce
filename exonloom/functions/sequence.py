"""Nucleotide and protein expressions (F1-F4, F7, F13, F15-F17); all but translation run inside the JVM."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from .codes import BASES, codon_table

#: Letters that are translated at once.
TRANSLATED = 4_000_000

# IUPAC letters and their complements (U pairs with A, X and N with themselves).
IUPAC = "ACGTRYSWKMBDHVN"
COMPLEMENT_FROM = "ACGTUMRWSYKVHDBXN"
COMPLEMENT_TO = "TGCAAKYWSRMBDHVXN"


def revcomp(seq: Column) -> Column:
    """Reverse complement, upper-cased; letters outside the alphabet are dropped."""
    kept = F.regexp_replace(F.upper(seq), f"[^{COMPLEMENT_FROM}]", "")
    return F.translate(F.reverse(kept), COMPLEMENT_FROM, COMPLEMENT_TO)


def _amino_acids(letters: np.ndarray, ends: np.ndarray, codes: np.ndarray, amino: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Amino acids of all rows and how many each row has; row ``i`` is ``letters[ends[i]:ends[i + 1]]``."""
    n = np.diff(ends) // 3
    if len(n) == 1:
        at = codes[letters[ends[0]:ends[0] + 3 * n[0]]].reshape(-1, 3)
        return amino[(at[:, 0] * 25 + at[:, 1] * 5 + at[:, 2])], n
    first = np.repeat(ends[:-1] - 3 * (np.cumsum(n) - n), n) + 3 * np.arange(n.sum())
    at = codes[letters]
    return amino[at[first] * 25 + at[first + 1] * 5 + at[first + 2]], n


def _translated(seq: pa.Array, codes: np.ndarray, amino: np.ndarray) -> pa.Array:
    # a letter outside ASCII is one place of an unknown codon
    text = pc.fill_null(seq, "").cast(pa.large_string())
    if not pc.all(pc.string_is_ascii(text)).as_py():
        text = pc.replace_substring_regex(text, r"[^\x00-\x7F]", "?")
    if len(text) == 0:
        return pa.array([], pa.string())
    ends = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1]
    letters = np.frombuffer(text.buffers()[2] or b"", np.uint8)
    made, sizes, a = [], [], 0
    while a < len(text):
        b = max(a + 1, int(np.searchsorted(ends, ends[a] + TRANSLATED, "right")) - 1)
        part, n = _amino_acids(letters[ends[a]:ends[b]], ends[a:b + 1] - ends[a], codes, amino)
        made.append(part)
        sizes.append(n)
        a = b
    offsets = np.concatenate([[0], np.cumsum(np.concatenate(sizes))]).astype(np.int32)
    out = pa.StringArray.from_buffers(len(text), pa.py_buffer(offsets), pa.py_buffer(np.concatenate(made)))
    return pc.if_else(pc.is_valid(seq), out, pa.scalar(None, pa.string())) if seq.null_count else out


def _codes(transl_table: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers 0 to 4 of the letters, and the amino acids of codons as numbers of base 5."""
    codes, amino = np.full(256, 4, np.uint8), np.full(125, ord("X"), np.uint8)
    codes[[ord(x) for x in BASES]] = range(4)
    for codon, aa in codon_table(transl_table).items():
        i, j, k = (int(codes[ord(x)]) for x in codon)
        amino[i * 25 + j * 5 + k] = ord(aa)
    return codes, amino


def translate(seq: Column, offset: Column | int = 0, transl_table: int = 1) -> Column:
    """Protein of the forward strand from a 0-based offset; unknown codons become X, a tail shorter than three is dropped."""
    codes, amino = _codes(transl_table)

    def run(part: pa.Array) -> pa.Array:
        return _translated(part, codes, amino)

    start = (F.lit(offset) if isinstance(offset, int) else offset) + 1
    return F.arrow_udf(run, "string")(F.substring(F.upper(seq), start, F.lit(2**31 - 1)))


def translate_cds(seq: Column, strand: Column, phase: Column | int = 0, transl_table: int = 1) -> Column:
    oriented = F.when(strand == "-", revcomp(seq)).otherwise(seq)
    return translate(oriented, phase, transl_table)


def six_frames(seq: Column, transl_table: int = 1) -> Column:
    """Array of six translations: three forward, then reverse offsets 0, 2, 1."""
    codes, amino = _codes(transl_table)

    def run(forward: pa.Array, reverse: pa.Array) -> pa.Array:
        frames = [_translated(pc.utf8_slice_codeunits(s, i), codes, amino) for s, order in ((forward, (0, 1, 2)), (reverse, (0, 2, 1))) for i in order]
        by_row = np.arange(6 * len(forward)).reshape(6, -1).T.ravel()
        return pa.ListArray.from_arrays(pa.array(np.arange(0, 6 * len(forward) + 1, 6), pa.int32()), pa.concat_arrays(frames).take(pa.array(by_row)))

    # both strands in one call, or the reverse one is made anew for each frame
    return F.arrow_udf(run, "array<string>")(F.upper(seq), revcomp(seq))


def internal_stops(protein: Column) -> Column:
    return F.length(protein) - F.length(F.translate(protein, "*", "")) - F.when(protein.endswith("*"), 1).otherwise(0)


def best_frame(seq: Column, strand: Column, transl_table: int = 1) -> Column:
    """Struct (stops, frame): the frame 1..3 with the fewest internal stops."""
    oriented = F.when(strand == "-", revcomp(seq)).otherwise(seq)
    options = [F.struct(internal_stops(translate(oriented, i, transl_table)).alias("stops"), F.lit(i + 1).alias("frame"))
               for i in range(3)]
    return F.array_min(F.array(*options))


def header_codon_start(header: Column) -> Column:
    found = F.regexp_extract(header, r"(?:^|\s)codon_start=(\d+)", 1)
    return F.coalesce(F.when(found != "", found.cast("int")), F.lit(1))


def translate_transcript(header: Column, seq: Column, transl_table: int = 1) -> Column:
    """oriented transcripts whose header may hold ``codon_start=n``."""
    return translate(seq, header_codon_start(header) - 1, transl_table)


def count_of(seq: Column, letters: str) -> Column:
    return F.length(seq) - F.length(F.translate(seq, letters, ""))


def gc_percent(seq: Column) -> Column:
    """(G + C + S) / length * 100; 0 for an empty sequence."""
    return F.when(F.length(seq) > 0, count_of(F.upper(seq), "GCS") * 100.0 / F.length(seq)).otherwise(F.lit(0.0))


def lower_count(seq: Column) -> Column:
    return F.length(seq) - F.length(F.regexp_replace(seq, "[a-z]", ""))


def trim_terminal_n(seq: Column) -> Column:
    """Struct (seq, left, right): sequence without leading/trailing N and what was cut."""
    lt = F.regexp_replace(seq, "^N+", "")
    rt = F.regexp_replace(lt, "N+$", "")
    return F.struct(rt.alias("seq"), (F.length(seq) - F.length(lt)).alias("left"), (F.length(lt) - F.length(rt)).alias("right"))


def trim_exons(exons: Column, left: Column, right: Column) -> Column:
    """the first exon starts later by ``left``, the last ends earlier by ``right``."""
    n = F.size(exons)
    return F.transform(exons, lambda e, i: F.struct(
        F.when(i == 0, e["start"] + left).otherwise(e["start"]).alias("start"),
        F.when(i == n - 1, e["end"] - right).otherwise(e["end"]).alias("end")))


def partial_start(protein: Column, codon_start: Column) -> Column:
    return ~((codon_start == 1) & protein.startswith("M"))


def partial_stop(protein: Column) -> Column:
    return ~protein.endswith("*")


def natural_key(name: Column) -> Column:
    """sorts embedded numbers by value, whatever their length: each is led by its number of digits."""
    parts = F.regexp_extract_all(name, F.lit(r"\d+|\D+"), F.lit(0))
    return F.array_join(F.transform(parts, lambda p: F.when(p.rlike(r"^\d+$"), F.concat(F.format_string("%09d", F.length(F.regexp_replace(p, "^0+(?=.)", ""))), F.regexp_replace(p, "^0+(?=.)", ""))).otherwise(p)), "")


def wrap(seq: Column, width: int = 80) -> Column:
    return F.regexp_replace(F.regexp_replace(seq, "(.{%d})" % width, "$1\n"), "\n$", "")


def span_length(exons: Column) -> Column:
    return F.aggregate(exons, F.lit(0).cast("long"), lambda acc, e: acc + e["end"] - e["start"] + 1)


def utr_parts(exons: Column, cds: Column, strand: Column) -> Column:
    """F16: struct (five, three) of exon parts outside the CDS span."""
    lo = F.array_min(F.transform(cds, lambda c: c["start"]))
    hi = F.array_max(F.transform(cds, lambda c: c["end"]))
    left = F.transform(F.filter(exons, lambda e: e["start"] < lo),
                       lambda e: F.struct(e["start"].alias("start"), F.least(e["end"], lo - 1).alias("end")))
    right = F.transform(F.filter(exons, lambda e: e["end"] > hi),
                        lambda e: F.struct(F.greatest(e["start"], hi + 1).alias("start"), e["end"].alias("end")))
    plus = strand == "+"
    return F.struct(F.when(plus, left).otherwise(right).alias("five"), F.when(plus, right).otherwise(left).alias("three"))


def aed(query: Column, reference: Column, zero_length: float = 1.0) -> Column:
    """1 - (SN + SP) / 2 with exon lengths ``end - start``; equal exon sets give 0."""
    total = lambda ex: F.aggregate(ex, F.lit(0).cast("long"), lambda acc, e: acc + e["end"] - e["start"])
    shared = F.aggregate(
        query, F.lit(0).cast("long"),
        lambda acc, q: acc + F.aggregate(reference, F.lit(0).cast("long"),
                                         lambda a2, r: a2 + F.greatest(F.lit(0).cast("long"),
                                                                       F.least(q["end"], r["end"]) - F.greatest(q["start"], r["start"]))))
    lq, lr = total(query), total(reference)
    value = 1 - (shared / lq + shared / lr) / 2
    return F.when(query == reference, F.lit(0.0)).when((lq > 0) & (lr > 0), value).otherwise(F.lit(zero_length))
