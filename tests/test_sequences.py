import random
from itertools import product

import pytest
import xxhash
from pyspark.sql import functions as F

from fusion_spark.functions import sequence as S
from fusion_spark.operators import sequences as Q
from fusion_spark.sources.annotation import read_fasta


def one(spark, expr, **values):
    row = spark.createDataFrame([tuple(values.values())], list(values)).select(expr.alias("v"))
    return row.first().v


def test_hash_matches_xxhash_for_every_length(spark):
    random.seed(1)
    seqs = ["".join(random.choice("ACGTN") for _ in range(n)) for n in range(150)]
    rows = spark.createDataFrame([(s,) for s in seqs], "s string").select(
        "s", S.xxh64_hex(F.col("s")).alias("h")
    ).collect()
    assert all(r.h == xxhash.xxh64(r.s).hexdigest() for r in rows)


def test_hash_golden(spark):
    assert one(spark, S.xxh64_hex(F.col("s")), s="ACGTTTA") == "a40d472865950d7c"


def test_reverse_complement_and_context(spark):
    assert one(spark, S.stranded(F.col("s"), F.lit("-")), s="ATCG") == "CGAT"
    assert one(spark, S.stranded(F.col("s"), F.lit("+")), s="ATCG") == "ATCG"
    assert one(spark, S.reverse_complement(F.col("s")), s="RYKMBVDHNacg") == "cgtNDHBVKMRY"
    joined = S.context_sequence(F.col("a"), F.col("b"), F.lit("-"), F.lit("+"))
    assert one(spark, joined, a="ACGTTTA", b="GGATC") == "TAAACGTGGATC"


def test_translate(spark):
    seq = "ATGGCCATTGTAATGGGCCGCTGAAAGGGTGCCCGATAG"
    assert one(spark, S.translate(F.col("s")), s=seq) == "MAIVMGR*KGAR*"
    assert one(spark, S.until_stop(S.translate(F.col("s"))), s=seq) == "MAIVMGR"
    # partial codon dropped, ambiguity resolved where all options agree, else X
    assert one(spark, S.translate(F.col("s")), s="GGNTARRAYNNNggaAT") == "G*BXG"
    # table 2: ATA is M, TGA is W, AGA is a stop
    mt = S.translate(F.col("s"), S.MITOCHONDRIAL_CODE)
    assert one(spark, mt, s="ATATGAAGA") == "MW*"
    assert one(spark, S.translate_for_chrom(F.col("s"), F.lit("MT")), s="TGA") == "W"
    assert one(spark, S.translate(F.col("s")), s="") == ""


def test_frames_and_breakpoints(spark):
    assert one(spark, S.from_frame(F.col("s"), F.lit(-1)), s="ACGT") == "T"
    assert one(spark, S.from_frame(F.col("s"), F.lit(1)), s="ACGT") == "CGT"
    assert one(spark, S.breakpoint_residue(F.lit(0), F.lit(2)), x=1) == -0.7
    assert one(spark, S.breakpoint_residue(F.lit(1), F.lit(0)), x=1) == 0.3
    # shown position never leaves less than 13 residues to the left when there are more
    assert one(spark, S.neo_peptide_breakpoint(F.lit(20.3)), x=1) == 13.3
    assert one(spark, S.neo_peptide_breakpoint(F.lit(-0.7)), x=1) == -0.7
    peptide = "ABCDEFGHIJKLMNOPQRSTUVWXYZABCDEFGHIJKLMNOPQRSTUVWXYZ"
    cut = S.neo_peptide(F.col("p"), F.lit(20.3), F.lit(True))
    assert one(spark, cut, p=peptide) == peptide[7:][: 13 + 13]
    assert one(spark, S.neo_peptide(F.col("p"), F.lit(20.3), F.lit(False)), p=peptide) == peptide[7:]


def test_fasta_wrap(spark):
    assert one(spark, S.wrap_fasta(F.col("s")), s="A" * 120) == "A" * 60 + "\n" + "A" * 60
    assert one(spark, S.fasta_record(F.lit("x"), F.col("s")), s="A" * 61) == ">x\n" + "A" * 60 + "\nA"


def test_fetch_across_chunks(no_broadcast):
    spark = no_broadcast
    random.seed(2)
    genome = {c: "".join(random.choice("ACGT") for _ in range(1000)) for c in ("1", "2")}
    chunks = Q.chunk_sequences(spark.createDataFrame(list(genome.items()), "chrom string, seq string"), 64)
    spans = [(random.choice("123"), a, a + random.randint(0, 300)) for a in random.choices(range(1, 1100), k=200)]
    rows = Q.fetch_sequences(
        spark.createDataFrame(spans, "chrom string, start bigint, stop bigint"), chunks, 64
    ).collect()
    assert len(rows) == len(set(spans))
    for r in rows:
        assert r.seq == genome.get(r.chrom, "")[r.start - 1 : r.stop]


def test_read_fasta(spark, tmp_path):
    random.seed(3)
    genome = {f"chr{i}": "".join(random.choice("ACGT") for _ in range(random.randint(1, 5000))) for i in range(30)}
    genome["one_line"] = "ACGT" * 3000
    path = tmp_path / "g.fa"
    with open(path, "w") as out:
        for name, seq in genome.items():
            out.write(f">{name} some description\n")
            width = len(seq) if name == "one_line" else 60
            for i in range(0, len(seq), width):
                out.write(seq[i : i + width] + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows = read_fasta(spark, str(path), 256).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    found = {}
    for r in sorted(rows, key=lambda r: (r.chrom, r.chunk)):
        assert len(r.seq) <= 256
        found[r.chrom] = found.get(r.chrom, "") + r.seq
    assert found == genome


@pytest.mark.parametrize("code", [S.STANDARD_CODE, S.MITOCHONDRIAL_CODE])
def test_every_codon(spark, code):
    letters = "ACGTMRWSYKVHDBNX -.Z\n"
    codons = ["".join(c) for c in product(letters, repeat=3)]
    plain, ambiguous = S._codon_tables(code)
    expected = "".join((plain | ambiguous).get(c, "X") for c in codons)
    assert len(S._look_up(code)[0].split(" ")[1]) == 66
    whole = "".join(codons)
    assert one(spark, S.translate(F.col("s"), code), s=whole) == expected
    assert one(spark, S.translate(F.col("s"), code), s=whole.lower().replace("t", "u")) == expected
    plain_only = "".join(c for c in codons if set(c) <= set("ACGT")) * 3
    for seq in (plain_only, plain_only[5:], plain_only[:100], plain_only[:24], "ACG", "AC"):
        got = one(spark, S.translate(F.col("s"), code), s=seq)
        assert got == "".join(plain[seq[i:i + 3]] for i in range(0, len(seq) - 2, 3))
    # the part before the first stop, from every frame of a text whose stops are far behind
    quiet = "".join(c for c in codons if (plain | ambiguous).get(c) != "*") * 3
    for seq in (quiet + "TAA" + quiet, quiet + "ac", "", "TA", "TAATTT"):
        got = one(spark, S.translate_to_stop(F.col("s"), code), s=seq)
        assert got == one(spark, S.until_stop(S.translate(F.col("s"), code)), s=seq)


def test_long_open_frame(spark):
    assert one(spark, S.translate_to_stop(F.col("s")), s="GCC" * 200_000 + "TGAGCC") == "A" * 200_000
