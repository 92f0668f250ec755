"""Nucleotide and peptide expressions; everything stays in the JVM."""

from __future__ import annotations

from functools import cache
from itertools import product

from pyspark.sql import Column
from pyspark.sql import functions as F

from fusion_spark.schemas import CONTEXT_LENGTH

# ---------------------------------------------------------------------------
# Nucleotide complements (IUPAC), codon tables 1 and 2 (NCBI order,
# first base slowest, bases T C A G), nucleotide and peptide ambiguity codes.
# ---------------------------------------------------------------------------
_COMPLEMENT_FROM = "ACGTUMRWSYKVHDBNacgtumrwsykvhdbn"
_COMPLEMENT_TO = "TGCAAKYWSRMBDHVNtgcaakywsrmbdhvn"
_BASES = "TCAG"
_CODE_1 = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
_CODE_2 = "FFLLSSSSYY**CCWWLLLLPPPPHHQQRRRRIIMMTTTTNNKKSS**VVVVAAAADDEEGGGG"
_BASE64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
_AMBIGUOUS_BASES = {
    "A": "A", "C": "C", "G": "G", "T": "T",
    "M": "AC", "R": "AG", "W": "AT", "S": "CG", "Y": "CT", "K": "GT",
    "V": "ACG", "H": "ACT", "D": "AGT", "B": "CGT", "N": "ACGT", "X": "ACGT",
}
_AMBIGUOUS_RESIDUES = {"DN": "B", "EQ": "Z", "IL": "J"}

STANDARD_CODE = 1
MITOCHONDRIAL_CODE = 2

# xxhash64 chains its arguments: the hash of one column seeds the next. This bigint
# hashes to 0 under Spark's initial seed 42, so it turns xxhash64(.., s) into the
# plain XXH64 of s with seed 0.
_SEED_ZERO = -365884300664092260


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, _COMPLEMENT_FROM, _COMPLEMENT_TO))


def stranded(seq: Column, strand: Column) -> Column:
    return F.when(strand == "-", reverse_complement(seq)).otherwise(seq)


def cut(seq: Column, start: Column, end: Column) -> Column:
    """``seq[start:end)`` with 0 <= start, clamped to the sequence."""
    return F.substring(seq, start.cast("int") + 1, (end - start).cast("int"))


def from_frame(seq: Column, frame: Column) -> Column:
    """Sequence from a reading-frame offset; an unknown frame (-1) leaves the last base."""
    return F.when(frame < 0, F.substring(seq, -1, 1)).otherwise(
        F.substring(seq, frame.cast("int") + 1, F.length(seq))
    )


def context_sequence(ft1: Column, ft2: Column, strand1: Column, strand2: Column) -> Column:
    return F.concat(stranded(ft1, strand1), stranded(ft2, strand2))


def leading(seq: Column, length: int) -> Column:
    """The first ``length`` bases, or all of fewer."""
    return F.substring(seq, 1, length)


def trailing(seq: Column, length: int) -> Column:
    """The last ``length`` bases, or all of fewer."""
    return cut(seq, F.greatest(F.lit(0), F.length(seq) - length), F.length(seq))


def window_around(seq: Column, bp: Column, length: int = CONTEXT_LENGTH) -> Column:
    """Up to ``length`` bases on either side of position ``bp``."""
    return cut(seq, F.greatest(F.lit(0), bp - length), bp + length)


@cache
def _codon_tables(code: int) -> tuple[dict[str, str], dict[str, str]]:
    residues = {STANDARD_CODE: _CODE_1, MITOCHONDRIAL_CODE: _CODE_2}[code]
    plain = dict(zip(("".join(c) for c in product(_BASES, repeat=3)), residues))
    ambiguous = {}
    for letters in product(_AMBIGUOUS_BASES, repeat=3):
        codon = "".join(letters)
        if codon in plain:
            continue
        options = {plain["".join(c)] for c in product(*(_AMBIGUOUS_BASES[b] for b in letters))}
        if len(options) == 1:
            ambiguous[codon] = options.pop()
        elif "".join(sorted(options)) in _AMBIGUOUS_RESIDUES:
            ambiguous[codon] = _AMBIGUOUS_RESIDUES["".join(sorted(options))]
    return plain, ambiguous


@cache
def _look_up(code: int) -> tuple[str, str]:
    """(codons, residues): the residue of a codon stands where the codon begins.

    The 64 codons of plain bases overlap in one text that holds each once, found by always
    appending a base that makes a new codon; ambiguous codons follow. The residue is X
    wherever no codon begins, also at the blank in front, which unlisted codons are given.
    """
    plain, ambiguous = _codon_tables(code)
    text = _BASES[0] * 2
    while new := [b for b in reversed(_BASES) if text[-2:] + b not in _codons_of(text)]:
        text += new[0]
    text = " " + text + "".join(f" {codon}" for codon in ambiguous)
    places = {text.index(codon): residue for codon, residue in (plain | ambiguous).items()}
    return text, "".join(places.get(place, "X") for place in range(len(text)))


def _codons_of(text: str) -> set[str]:
    return {text[i:i + 3] for i in range(len(text) - 2)}


def _bases(seq: Column) -> Column:
    return F.replace(F.upper(seq), F.lit("U"), F.lit("T"))


def _residues(bases: Column, code: int) -> Column:
    """One residue per codon. Plain bases are translated as numbers, others codon by codon."""
    plain = F.rlike(bases, F.lit(f"^[{_BASES}]*+$"))
    return F.when(plain, _by_number(bases, code)).otherwise(_by_search(bases, code))


def _by_number(bases: Column, code: int) -> Column:
    """A codon of plain bases is six bits, which is one digit of the base-64 notation.

    Pieces of 24 bases become 48-bit numbers in hexadecimal notation; all further steps take
    the sequence as a whole.
    """
    residues = {STANDARD_CODE: _CODE_1, MITOCHONDRIAL_CODE: _CODE_2}[code]
    full = F.ceil(F.length(bases) / 24).cast("int") * 24
    digits = F.rpad(F.translate(bases, _BASES, "0123"), full, F.lit("0"))
    numbers = F.transform(
        F.regexp_extract_all(digits, F.lit(".{24}"), F.lit(0)),
        lambda piece: F.lpad(F.conv(piece, 4, 16), 12, "0"),
    )
    notation = F.base64(F.unhex(F.array_join(numbers, "")))
    return F.substring(
        F.translate(notation, _BASE64 + "\r\n", residues), F.lit(1),
        F.floor(F.length(bases) / 3).cast("int"),
    )


def _by_search(bases: Column, code: int) -> Column:
    """A codon is found by one search in a text of some hundred letters."""
    text, residues = (F.lit(part) for part in _look_up(code))
    codon = F.regexp_extract_all(bases, F.lit("(?s).{3}"), F.lit(0))
    return F.array_join(
        F.transform(codon, lambda c: F.substring(residues, F.instr(text, c), F.lit(1))), "")


def translate(seq: Column, code: int = STANDARD_CODE) -> Column:
    """Peptide of a coding sequence; stops stay as ``*``, unresolvable codons become X.

    A trailing partial codon is dropped.
    """
    return _residues(_bases(seq), code)


def translate_to_stop(seq: Column, code: int = STANDARD_CODE) -> Column:
    """The peptide before the first stop; the sequence is cut there before it is translated."""
    plain, ambiguous = _codon_tables(code)
    stops = "|".join(c for c, residue in (plain | ambiguous).items() if residue == "*")
    open_frame = F.regexp_extract(_bases(seq), f"^(?s:(?!{stops}).{{3}})*+", 0)
    return _residues(open_frame, code)


def translate_for_chrom(seq: Column, chrom: Column) -> Column:
    """Mitochondrial genes use their own codon table."""
    return F.when(chrom == "MT", translate(seq, MITOCHONDRIAL_CODE)).otherwise(translate(seq))


def until_stop(peptide: Column) -> Column:
    return F.substring_index(peptide, "*", 1)


def wildtype_peptide(cds: Column, chrom: Column, strand: Column, frame: Column) -> Column:
    return translate_for_chrom(from_frame(stranded(cds, strand), frame), chrom)


def xxh64_hex(seq: Column) -> Column:
    """XXH64 (seed 0) of the text as 16 lower-case hex digits."""
    return F.lpad(F.lower(F.hex(F.xxhash64(F.lit(_SEED_ZERO), seq))), 16, "0")


def breakpoint_residue(nucleotides: Column, frame: Column) -> Column:
    """Breakpoint in residues, in tenths: x.0 / x.3 / x.6 by codon position."""
    return F.floor((nucleotides - frame) * 10 / 3) / 10


def decimal_of_tenths(tenths: Column) -> Column:
    """Decimal number of a whole number of tenths, as -0.7; never in exponent notation."""
    size = F.abs(tenths)
    sign = F.when(tenths < 0, "-").otherwise("")
    return F.concat(sign, F.floor(size / 10).cast("string"), F.lit("."), (size % 10).cast("string"))


def _whole(value: Column) -> Column:
    """Truncation towards zero."""
    return value.cast("int")


NEO_PEPTIDE_FLANK = 13


def neo_peptide_breakpoint(bp: Column) -> Column:
    shift = _whole(bp) - NEO_PEPTIDE_FLANK
    return F.when(shift < 0, F.round(bp, 1)).otherwise(F.round(bp - shift, 1))


def neo_peptide(peptide: Column, bp: Column, in_frame: Column) -> Column:
    """Peptide around the breakpoint; only in-frame products are cut on the right."""
    start = F.greatest(F.lit(0), _whole(bp) - NEO_PEPTIDE_FLANK)
    tail = F.substring(peptide, start + 1, F.length(peptide))
    keep = _whole(neo_peptide_breakpoint(bp)) + NEO_PEPTIDE_FLANK
    return F.when(in_frame, F.substring(tail, F.lit(1), keep)).otherwise(tail)


def wrap_fasta(seq: Column, width: int = 60) -> Column:
    """Sequence text in lines of ``width`` characters."""
    return F.regexp_replace(seq, f"(.{{{width}}})(?=.)", "$1\n")


def fasta_record(name: Column, seq: Column) -> Column:
    return F.concat(F.lit(">"), name, F.lit("\n"), wrap_fasta(seq))
