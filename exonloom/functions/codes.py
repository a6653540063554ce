"""NCBI genetic codes as the standard code plus the codons each table reassigns."""

from __future__ import annotations

BASES = "TCAG"
# Amino acids of the standard code in TCAG order.
STANDARD = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"

# Reassignments per NCBI table id. Codons that a table reads both as
# an amino acid and as a stop count as stops, hence the short rows 27, 28 and 31.
REASSIGNED = {
    1: "",
    2: "AGA* AGG* ATAM TGAW",
    3: "ATAM CTTT CTCT CTAT CTGT TGAW",
    4: "TGAW",
    5: "AGAS AGGS ATAM TGAW",
    6: "TAAQ TAGQ",
    9: "AAAN AGAS AGGS TGAW",
    10: "TGAC",
    11: "",
    12: "CTGS",
    13: "AGAG AGGG ATAM TGAW",
    14: "AAAN AGAS AGGS TAAY TGAW",
    15: "TAGQ",
    16: "TAGL",
    21: "AAAN AGAS AGGS ATAM TGAW",
    22: "TCA* TAGL",
    23: "TTA*",
    24: "AGAS AGGK TGAW",
    25: "TGAG",
    26: "CTGA",
    27: "TAAQ TAGQ",
    28: "",
    29: "TAAY TAGY",
    30: "TAAE TAGE",
    31: "TGAW",
    32: "TAGW",
    33: "AGAS AGGK TAAY TGAW",
}


# Start codons per NCBI table id.
STARTS = {
    1: "TTG CTG ATG",
    2: "ATT ATC ATA ATG GTG",
    3: "ATA ATG GTG",
    4: "TTA TTG CTG ATT ATC ATA ATG GTG",
    5: "TTG ATT ATC ATA ATG GTG",
    6: "ATG",
    9: "ATG GTG",
    10: "ATG",
    11: "TTG CTG ATT ATC ATA ATG GTG",
    12: "CTG ATG",
    13: "TTG ATA ATG GTG",
    14: "ATG",
    15: "ATG",
    16: "ATG",
    21: "ATG GTG",
    22: "ATG",
    23: "ATT ATG GTG",
    24: "TTG CTG ATG GTG",
    25: "TTG ATG GTG",
    26: "CTG ATG",
    27: "ATG",
    28: "ATG",
    29: "ATG",
    30: "ATG",
    31: "ATG",
    32: "TTG CTG ATT ATC ATA ATG GTG",
    33: "TTG CTG ATG GTG",
}


def stop_codons(transl_table: int = 1) -> set[str]:
    return {codon for codon, amino in codon_table(transl_table).items() if amino == "*"}


def start_codons(transl_table: int = 1) -> set[str]:
    codon_table(transl_table)  # an unknown table raises
    return set(STARTS[transl_table].split())


def valid_tables() -> list[int]:
    return sorted(REASSIGNED)


def codon_table(transl_table: int = 1) -> dict[str, str]:
    if transl_table not in REASSIGNED:
        raise ValueError(f"unknown translation table {transl_table}")
    codons = [a + b + c for a in BASES for b in BASES for c in BASES]
    table = dict(zip(codons, STANDARD))
    table.update((w[:3], w[3]) for w in REASSIGNED[transl_table].split())
    return table
