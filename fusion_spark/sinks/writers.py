"""Writers of tables, delimited text and FASTA."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fusion_spark import schemas
from fusion_spark.operators import model
from fusion_spark.operators import sequences as Q
from fusion_spark.plans.annotate import filtered_annotation

MISSING = "NA"


def write_table(df: DataFrame, path: str, by: tuple[str, ...] = ("sample",)) -> None:
    """Parquet between stages, one folder per sample.

    Rows are rebalanced by sample: adaptive execution gathers small samples in few files and
    splits a large one, so the number of files follows the data and not tasks x samples.
    """
    keys = [c for c in by if c in df.columns]
    rows = df.hint("rebalance", *keys) if keys else df
    rows.write.mode("overwrite").partitionBy(*keys).parquet(path)


def as_text(column: Column, kind: T.DataType) -> Column:
    """Text of a column for delimited files; nested values as JSON."""
    if isinstance(kind, (T.ArrayType, T.StructType, T.MapType)):
        return F.to_json(column)
    return column.cast("string")


def text_columns(df: DataFrame, missing: str | None = None) -> DataFrame:
    columns = []
    for field in df.schema.fields:
        text = as_text(F.col(f"`{field.name}`"), field.dataType)
        if missing is not None:
            text = F.coalesce(text, F.lit(missing))
        columns.append(text.alias(field.name))
    return df.select(*columns)


def write_delimited(
    df: DataFrame, path: str, sep: str = ";", missing: str | None = None,
    by_sample: bool = False,
) -> None:
    """Delimited text with a header in every part file; ``by_sample`` gives sample folders."""
    writer = (
        text_columns(df, missing).write.mode("overwrite")
        .option("sep", sep).option("header", True).option("emptyValue", "")
        .option("nullValue", "")
    )
    if by_sample and "sample" in df.columns:
        writer = writer.partitionBy("sample")
    writer.csv(path)


def write_tool_calls(calls: DataFrame, path: str) -> None:
    write_delimited(calls.select(*schemas.TOOL_COLUMNS), path)


def write_detected(detected: DataFrame, path: str, table_path: str | None = None) -> None:
    """Detected fusions as text and, if asked for, as a table by sample and tool."""
    rows = detected.select(*schemas.DETECTED_COLUMNS)
    write_delimited(rows, path)
    if table_path is not None:
        write_table(rows, table_path, ("Sample", "Tool"))


def write_annotation(annotated: DataFrame, prefix: str, excluded_tsl: str) -> None:
    """All annotation outputs under one prefix.

    ``.debug`` holds every row and column, the prefix itself the filtered short table; FASTA
    files follow for contexts (filtered), transcripts and peptides (all), with the context
    summary in ``.fasta.info``. ``annotated`` should be a stored table: it is read per output.
    """
    kept = filtered_annotation(annotated, excluded_tsl)
    write_delimited(annotated.select(*schemas.ANNOTATION_COLUMNS), f"{prefix}.debug")
    write_delimited(kept.select(*schemas.ANNOTATION_SHORT_COLUMNS), prefix)
    write_lines(Q.context_records(kept), f"{prefix}.fasta")
    write_lines(Q.transcript_records(annotated), f"{prefix}_transcript.fasta")
    write_lines(Q.peptide_records(annotated), f"{prefix}_peptide.fasta")
    write_lines(info_lines(Q.fasta_info(kept)), f"{prefix}.fasta.info")


def info_lines(info: DataFrame) -> DataFrame:
    lines = F.array(*[F.concat(F.lit(f"{c}="), F.col(c)) for c in info.columns])
    return info.select(F.explode(lines).alias("value"))


def write_lines(lines: DataFrame, path: str) -> None:
    lines.select("value").write.mode("overwrite").text(path)


def write_seq_table(seq_table: DataFrame, path: str, fasta_path: str | None = None) -> None:
    rows = seq_table.select("name", "sequence", "position")
    write_delimited(rows, path)
    if fasta_path is not None:
        write_lines(Q.named_records(rows), fasta_path)


def write_mates(split: DataFrame, path: str) -> None:
    """Reads by mate group, one folder each."""
    split.write.mode("overwrite").partitionBy("sample", "mate").parquet(path)


def write_candidates(merged: DataFrame, path: str) -> tuple[int, int]:
    """Merged candidate table with ``NA`` for missing values; returns rows and columns written.

    The rows are counted while they are written.
    """
    written = Observation()
    counted = merged.observe(written, F.count(F.lit(1)).alias("rows"))
    write_delimited(counted, path, missing=MISSING, by_sample=True)
    return written.get["rows"], len([c for c in merged.columns if c != "sample"])


def all_path(path: str) -> str:
    """``X.csv`` to ``X.all.csv``."""
    return path.replace(".csv", "", 1) + ".all.csv"


def write_predictions(scored: DataFrame, path: str) -> None:
    """Positive candidates at ``path``, all of them next to it."""
    write_delimited(model.positives(scored), path, missing=MISSING, by_sample=True)
    write_delimited(scored, all_path(path), missing=MISSING, by_sample=True)


def write_tsl(tsl: DataFrame, path: str) -> None:
    write_delimited(tsl.select(*schemas.TSL_COLUMNS), path, sep="\t")
