"""Personal data: fixed formats, and identifiers found by bootstrapped contexts."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fusion_spark.llm.store import stored
from fusion_spark.llm.words import slices, texts_of

# The kinds in their order, and the formats of their seeds.
KINDS = ("email", "ip", "card", "phone")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

LEAST_SEEDS = 5  # different seeds that a pattern must surround
SURE = 0.85  # least confidence of a pattern that is used and of an instance that is reported
ROUNDS = 3
_LIKE = re.compile(r"[0-9@]")
_TRIM = ".,;:!?\"'()[]{}<>|*#%&$"

Span = tuple[int, int, str]


def _emails(text: str) -> Iterator[Span]:
    """The local part is the run of allowed characters before the ``@``."""
    free = 0
    for match in _DOMAIN.finditer(text):
        at = match.start()
        reach = 64
        while True:
            part = text[max(free, at - reach):at]
            rest = part.rstrip(_LOCAL)
            if rest or at - reach <= free:
                break
            reach *= 4
        if len(rest) < len(part):
            yield at - len(part) + len(rest), match.end(), "email"
            free = match.end()


def _luhn(digits: str) -> bool:
    doubled = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (doubled + sum(map(int, digits[-1::-2]))) % 10 == 0


def _digits(text: str) -> str:
    return "".join(filter(str.isdigit, text))


def base_spans(text: str) -> list[Span]:
    """(start, end exclusive, kind) in code points, by start and then by kind.

    Leftmost and without overlap within a kind; a match that fails its test is dropped.
    """
    found = list(_emails(text)) if "@" in text else []
    for match in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in match[0].split(".")):
            found.append((match.start(), match.end(), "ip"))
    for match in _CARD.finditer(text):
        if match.end() - match.start() >= 14:
            digits = _digits(match[0])
            if 14 <= len(digits) <= 19 and _luhn(digits):
                found.append((match.start(), match.end(), "card"))
    if "+" in text:
        for match in _PHONE.finditer(text):
            if 10 <= len(_digits(match[0])) <= 15:
                found.append((match.start(), match.end(), "phone"))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def candidates(text: str, spans: list[Span]) -> list[tuple[str, str, int, int, list[str]]]:
    """(kind or '', instance, start, end, patterns) of the seeds and of every other token
    that has a digit or an ``@``. A pattern is two words before the slot, or a word on
    either side."""
    slots = [(start, end, kind) for start, end, kind in spans]
    taken = sorted((start, end) for start, end, _ in spans)
    after, place = 0, 0
    for match in _LIKE.finditer(text):
        at = match.start()
        if at < after:
            continue
        while place < len(taken) and taken[place][1] <= at:
            place += 1
        if place < len(taken) and taken[place][0] <= at:
            after = taken[place][1]
            continue
        start = at
        while start > after and not text[start - 1].isspace():
            start -= 1
        space = re.compile(r"\s|$").search(text, at)
        end = after = space.start() if space else len(text)
        if place < len(taken):
            end = min(end, taken[place][0])
        token = text[start:end]
        start += len(token) - len(token.lstrip(_TRIM))
        token = token.strip(_TRIM)
        if len(token) >= 5:
            slots.append((start, start + len(token), ""))
    out = []
    for start, end, kind in slots:
        before = text[max(0, start - 80):start].lower().split()[-2:]
        behind = text[end:end + 40].lower().split()[:1]
        patterns = [" ".join([*before, "_"])] if len(before) == 2 else []
        if before and behind:
            patterns.append(f"{before[-1]} _ {behind[0]}")
        out.append((kind, text[start:end].lower(), start, end, patterns))
    return out


def text_key(text: str) -> bytes:
    return hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).digest()


def written(spans: Iterable[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


_SEEN = pa.schema([
    ("doc_id", pa.int64()), ("key", pa.binary()), ("base", pa.string()),
    *((f"n_{kind}", pa.int64()) for kind in KINDS),
    ("slots", pa.list_(pa.struct([
        ("kind", pa.string()), ("instance", pa.string()), ("start", pa.int64()),
        ("end", pa.int64()), ("patterns", pa.list_(pa.string())),
    ]))),
])
_SEEN_SQL = (
    "doc_id long, key binary, base string, " + ", ".join(f"n_{kind} long" for kind in KINDS)
    + ", slots array<struct<kind: string, instance: string, start: long, end: long,"
    " patterns: array<string>>>"
)


def survey(docs: DataFrame) -> DataFrame:
    """Per row: its base spans, their counts, and the slots that bootstrapping looks at."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            names = batch.column("doc_id").to_pylist()
            for name, text in zip(names, texts_of(batch, "text"), strict=True):
                spans = base_spans(text)
                kinds = [kind for _, _, kind in spans]
                rows.append({
                    "doc_id": name, "key": text_key(text), "base": written(spans),
                    **{f"n_{kind}": kinds.count(kind) for kind in KINDS},
                    "slots": [
                        dict(zip(("kind", "instance", "start", "end", "patterns"), slot,
                                 strict=True))
                        for slot in candidates(text, spans)
                    ],
                })
            yield pa.RecordBatch.from_pylist(rows, schema=_SEEN)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, _SEEN_SQL)


def bootstrap(
    seen: DataFrame, rounds: int = ROUNDS, least: int = LEAST_SEEDS, sure: float = SURE
) -> tuple[DataFrame, DataFrame]:
    """Confident patterns (pattern, kind, sure) and the instances they discover
    (instance, kind, score).

    The graph has an edge for each pattern and each different instance in its slot. A pattern
    of a kind is as sure as the share of its instances that are, by their own scores, of that
    kind (one instance is added against it); an instance is as sure as its patterns taken
    together (one minus the product of their doubts). Seeds are sure. Each round scores all
    patterns and then all other instances.
    """
    edges = stored(
        seen.select(F.explode("slots").alias("slot"))
        .select(F.explode("slot.patterns").alias("pattern"), "slot.instance", "slot.kind")
        .groupBy("pattern", "instance").agg(F.max("kind").alias("kind"))
    )
    size = edges.groupBy("pattern").agg(
        F.count("*").alias("size"), F.count_if(F.col("kind") != "").alias("seeds"))
    open_patterns = size.filter(F.col("seeds") >= least).drop("seeds")
    edges = stored(edges.join(open_patterns, "pattern"))
    scores = seen.sparkSession.createDataFrame([], "instance string, kind string, score double")
    patterns = seen.sparkSession.createDataFrame([], "pattern string, kind string, sure double")
    if edges.isEmpty():
        return patterns, scores
    seeds = edges.filter("kind != ''").select(
        "pattern", "size", "kind", F.lit(1.0).alias("score"), F.lit(1).alias("seed"))
    others = edges.filter("kind = ''").drop("kind")
    for _ in range(rounds):
        told = others.join(scores, "instance").select(
            "pattern", "size", "kind", "score", F.lit(0).alias("seed"))
        patterns = stored(
            seeds.unionByName(told).groupBy("pattern", "kind")
            .agg(F.sum("score").alias("sum"), F.sum("seed").alias("seeds"),
                 F.max("size").alias("size"))
            .withColumn("sure", F.col("sum") / (F.col("size") + 1))
            .filter((F.col("seeds") >= least) & (F.col("sure") >= sure / 2))
            .select("pattern", "kind", "sure")
        )
        if patterns.isEmpty():
            break
        doubt = F.exp(F.sum(F.log1p(-F.least("sure", F.lit(0.999)))))
        scores = stored(
            others.join(patterns, "pattern").groupBy("instance", "kind")
            .agg((1 - doubt).alias("score"), F.max("sure").alias("sure"))
            .filter((F.col("score") >= sure) & (F.col("sure") >= sure)).drop("sure")
        )
    return patterns.filter(F.col("sure") >= sure), scores


def find_pii(docs: DataFrame, **options) -> DataFrame:
    """Per row: doc_id, key (of the text), base and spans (``kind:start:end``, by start and
    then kind), counts of the base spans, and n_found discovered spans.

    Whole texts are searched; null counts as empty and has no spans. A discovered span stands
    in the slot of a confident pattern, holds an instance that is confident for the same kind,
    and overlaps no base span. Repeated rows give repeated results, an empty table an empty
    one; no column but ``doc_id`` and ``text`` is read.
    """
    seen = stored(survey(docs))
    patterns, scores = bootstrap(seen, **options)
    slots = seen.filter(F.exists("slots", lambda s: s["kind"] == "")).select(
        "doc_id", "key", F.explode("slots").alias("slot")).filter("slot.kind = ''")
    in_pattern = (
        slots.select("doc_id", "key", "slot.instance", "slot.start", "slot.end",
                     F.explode("slot.patterns").alias("pattern"))
        .join(patterns, "pattern")
        .join(scores, ["instance", "kind"])
        .groupBy("doc_id", "key", "start", "end")
        .agg(F.max_by("kind", F.struct("score", "kind")).alias("kind"))
        .groupBy("doc_id", "key")
        .agg(F.collect_list(F.struct("start", "end", "kind")).alias("found"))
    )
    columns = ["doc_id", "key", "base", *(f"n_{kind}" for kind in KINDS)]
    if scores.isEmpty():
        return seen.select(
            *columns, F.col("base").alias("spans"), F.lit(0).cast("long").alias("n_found"),
            F.array().cast("array<struct<start: long, end: long, kind: string>>").alias("found"),
        )
    joined = seen.select(*columns).join(in_pattern, ["doc_id", "key"], "left")
    base = F.expr("""
        transform(filter(split(base, ','), s -> s != ''), s -> named_struct(
            'start', cast(split(s, ':')[1] as long), 'end', cast(split(s, ':')[2] as long),
            'kind', split(s, ':')[0]))
    """)
    ranked = F.expr(f"""
        array_join(transform(array_sort(transform(
            concat(_base, coalesce(found, array())), s -> named_struct(
                'start', s.start,
                'place', array_position(array({', '.join(map(repr, KINDS))}), s.kind),
                'end', s.end, 'kind', s.kind))),
            s -> concat(s.kind, ':', s.start, ':', s.end)), ',')
    """)
    return joined.withColumn("_base", base).select(
        *columns, ranked.alias("spans"),
        F.size(F.coalesce("found", F.array())).cast("long").alias("n_found"), "found",
    )


def mask(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with every span of its texts replaced by its kind, as in ``<EMAIL>``.

    Overlapping spans become one mask of the first kind. Null texts stay null; other columns
    stay as they are.
    """
    key_of = F.pandas_udf(_keys, "binary")
    masked = F.pandas_udf(_masked, "string")
    found = find_pii(docs, **options).filter("n_found > 0").select(
        "doc_id", "key", "found").dropDuplicates(["doc_id", "key"])
    if found.isEmpty():
        return docs.withColumn("text", masked("text", F.lit(None).cast(_FOUND)))
    keyed = docs.select(F.struct(*docs.columns).alias("row"), key_of("text").alias("own"))
    same = keyed["row.doc_id"].eqNullSafe(found["doc_id"]) & (keyed["own"] == found["key"])
    return keyed.join(found, same, "left").select(*(
        masked("row.text", "found").alias("text") if name == "text"
        else F.col("row").getField(name).alias(name) for name in docs.columns))


_FOUND = "array<struct<start: long, end: long, kind: string>>"


def _keys(texts: pd.Series) -> pd.Series:
    return texts.map(lambda text: text_key(text or ""))


def _masked(texts: pd.Series, found: pd.Series) -> pd.Series:
    return texts.combine(found, mask_text)


def mask_text(text: str | None, found) -> str | None:
    if text is None:
        return None
    spans = base_spans(text)
    if found is not None:
        spans = sorted([*spans, *((s["start"], s["end"], s["kind"]) for s in found)])
    out, done = [], 0
    for start, end, kind in spans:
        if start >= done:
            out += [text[done:start], f"<{kind.upper()}>"]
        done = max(done, end)
    return "".join([*out, text[done:]])
