"""Secrets in texts, with corpus-wide ownership of every candidate.

The base kinds are found by their patterns. The method adds kind ``live``: long mixed strings that no base
span covers. Each candidate value, base or added, is hashed, and the hashes are counted over the corpus by
distinct owner and distinct repository. A value with more than ``max_owners`` owners is a widely copied
example; one with fewer looks like somebody's own live credential. Added spans are those that look live; base
spans always stay, and the verdict tells which of them look live.

Spark has no function for the places of all matches, so they come from the pieces between them: the lengths
of the pieces and matches before one add up to its start. Only texts that match at all are taken apart. An array
that grows match by match would be copied each time, so pieces are added up in blocks, added candidates are held
against the base spans by one sorted look over a text's spans, and texts are redacted in blocks: the work
follows the text's length, whatever it holds.
Counting first collapses equal (hash, owner, repository) rows, so a value in a third of all rows is no hot
group; the join that brings verdicts back has one row per hash on one side, which Spark splits if skewed.

Defined cases: a null text is the empty text, without spans. A null owner or repository counts as one of its
own. Null ids, repeated ids and repeated rows keep their row each. Texts of any length are searched whole. An empty
table gives an empty result; further columns are not read, and redaction returns them as they are, whatever
their names.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airpanel.llm.common import quoted, text_of, whole_rows, written

ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"  # a run too short at its first AKIA is too short at any later one
HEX = r"[0-9a-f]{24,}"
#: Kind -> (pattern, group that holds the secret, least length of that group); the order breaks ties of spans.
BASE = {"assign": (ASSIGN, 2, 6), "access": (ACCESS, 0, 20), "hex": (HEX, 0, 24)}
#: A long unbroken string; those with too few different characters, or no digit, letter or change of kind, are no candidates.
LIVE = r"[A-Za-z0-9+/_=-]{20,}"
MIN_DIFFERENT = 10
PLACEHOLDER = "[SECRET]"
SPAN = "array<struct<start:int,rank:int,end:int,kind:string,value:string>>"
#: Matches added up at a time, and characters redacted at a time.
MATCHES, CHARS = 128, 2048


def _spans(text: Column, kind: str, pattern: str, group: int, least: int, rank: int) -> Column:
    """Spans of one kind: code points from 0, the end exclusive. Matches with a short group are dropped."""
    gaps = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = found if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))

    def placed(parts: Column) -> Column:
        # Fold over (gap, match, value), carrying where the next gap starts.
        return F.aggregate(
            parts, F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("spans")),
            lambda acc, p: F.struct(
                (acc["at"] + F.length(p["gap"]) + F.length(p["match"])).alias("at"),
                F.when(F.length(p["value"]) >= least, F.concat(acc["spans"], F.array(F.struct(
                    (acc["at"] + F.length(p["gap"])).alias("start"), F.lit(rank).alias("rank"),
                    (acc["at"] + F.length(p["gap"]) + F.length(p["match"])).alias("end"),
                    F.lit(kind).alias("kind"), p["value"].alias("value"),
                )))).otherwise(acc["spans"]).alias("spans"),
            ),
        )

    def moved(blocks: Column) -> Column:
        # The blocks' spans, each moved on by the lengths of the blocks before.
        begins = F.aggregate(blocks, F.array(F.lit(0)), lambda acc, b: F.concat(acc, F.array(F.element_at(acc, -1) + b["at"])))
        shift = lambda s, by: s.withField("start", s["start"] + by).withField("end", s["end"] + by)
        each = F.zip_with(blocks, begins, lambda b, by: F.transform(F.coalesce(b["spans"], F.array().cast(SPAN)), lambda s: shift(s, by)))
        return F.flatten(each)

    zipped = F.arrays_zip(gaps.alias("gap"), found.alias("match"), values.alias("value"))
    parts = F.filter(zipped, lambda p: p["match"].isNotNull())
    numbers = lambda p: F.sequence(F.lit(0), F.floor((F.size(p) - 1) / MATCHES).cast("int"))
    blocks = _let(parts, lambda p: F.transform(numbers(p), lambda i: placed(F.slice(p, i * MATCHES + 1, F.lit(MATCHES)))))
    return F.when(text.rlike(pattern), _let(blocks, moved)).otherwise(F.array().cast(SPAN))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def candidates(df: DataFrame, text: Column) -> DataFrame:
    """Adds ``spans``: the base spans, and candidates for kind ``live`` that may overlap them."""
    base = [_spans(text, k, p, g, n, i) for i, (k, (p, g, n)) in enumerate(BASE.items())]
    mixed = lambda v: (
        (F.size(F.array_distinct(F.split(v, ""))) >= MIN_DIFFERENT) & v.rlike("[0-9]") & v.rlike("[A-Za-z]")
        & (v.rlike("[A-Z]") & v.rlike("[a-z]") | v.rlike("[0-9][A-Za-z]+[0-9]"))
    )
    more = F.filter(_spans(text, "live", LIVE, 0, 20, len(BASE)), lambda s: mixed(s["value"]))
    return df.withColumn("spans", F.concat(*base, more))


def _uncovered(found: DataFrame) -> DataFrame:
    """Spans (row, s) without the candidates that a base span overlaps, by one look at a row's spans in order."""
    of_base = F.col("s.kind") != "live"
    order = Window.partitionBy("row").orderBy("s.start", "s.rank")
    before = F.max(F.when(of_base, F.col("s.end"))).over(order.rowsBetween(Window.unboundedPreceding, -1))
    after = F.expr("lead(CASE WHEN s.kind <> 'live' THEN s.start END, 1) IGNORE NULLS OVER (PARTITION BY row ORDER BY s.start, s.rank)")
    looked = found.withColumn("_before", before).withColumn("_after", after)
    covered = (F.coalesce("_before", F.lit(0)) > F.col("s.start")) | (F.col("_after") < F.col("s.end"))
    return looked.filter(of_base | ~F.coalesce(covered, F.lit(False))).drop("_before", "_after")


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def ownership(found: DataFrame) -> DataFrame:
    """(hash, owners, repositories) of candidate rows (hash, owner, repository)."""
    once = found.groupBy("hash", "owner", "repository").agg(F.lit(1).alias("one"))
    # A null owner is an owner; countDistinct would pass over it.
    owner = F.struct("owner")
    return once.groupBy("hash").agg(
        F.count_distinct(owner).alias("owners"), F.count_distinct(F.struct("owner", "repository")).alias("repositories"),
    )


def scan_secrets(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
    repository_cols: Sequence[str] = ("source", "lang"), max_owners: int = 3,
) -> DataFrame:
    """One row per row of ``df``: id, ``key`` (hash of id and text), counts, base and final spans, live spans.

    ``found`` holds every span with its owners and whether it looks live.
    """
    rows = df.select(
        F.col(id_col).alias("id"), F.col(owner_col).cast("string").alias("owner"),
        F.to_json(F.struct(*repository_cols)).alias("repository"), text_of(text_col).alias("text"),
    )
    rows = candidates(rows.withColumn("key", F.xxhash64("id", "text")), F.col("text")).select(
        "id", "key", "owner", "repository",
        F.transform("spans", lambda s: s.withField("hash", F.sha2(s["value"], 256)).dropFields("value")).alias("spans"),
    )
    rows = written(rows.withColumn("row", F.monotonically_increasing_id()), "secret-spans")
    found = _uncovered(rows.select("row", "owner", "repository", F.explode("spans").alias("s"))).withColumn("hash", F.col("s.hash"))
    owners = ownership(found.select("hash", "owner", "repository"))
    judged = (
        found.select("row", "s", "hash").join(owners, "hash")
        .withColumn("live", F.col("owners") <= max_owners)
        .filter((F.col("s.kind") != "live") | F.col("live"))
        .groupBy("row").agg(F.array_sort(F.collect_list(F.struct(
            F.col("s.start").alias("start"), F.col("s.rank").alias("rank"), F.col("s.end").alias("end"),
            F.col("s.kind").alias("kind"), F.col("s.hash").alias("hash"), "owners", "repositories", "live",
        ))).alias("found"))
    )
    result = rows.drop("spans").join(judged, "row", "left")
    spans = F.coalesce("found", F.array().cast(judged.schema["found"].dataType))
    of = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
    return result.select(
        F.col("id").alias(id_col), *[of(k).alias(f"n_{k}") for k in BASE],
        F.sha2(_joined(F.filter(spans, lambda s: s["kind"] != "live")), 256).alias("base_sha256"),
        _joined(spans).alias("spans"), F.size(F.filter(spans, lambda s: s["live"])).cast("long").alias("n_live"),
        spans.alias("found"), "key",
    )


def _cut(block: Column, cuts: Column) -> Column:
    """A block of text without the characters that ``cuts`` (sorted, apart) name; a placeholder where a span begins."""
    walked = F.aggregate(
        cuts, F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts")),
        lambda acc, c: F.struct(
            c["hi"].alias("at"),
            F.concat(acc["parts"], F.array(
                F.substring(block, acc["at"] + 1, c["lo"] - acc["at"]), F.when(c["head"], F.lit(PLACEHOLDER)).otherwise(F.lit("")),
            )).alias("parts"),
        ),
        lambda acc: F.concat(acc["parts"], F.array(F.substring(block, acc["at"] + 1, F.length(block)))),
    )
    return F.array_join(walked, "")


def _cuts(found: DataFrame) -> DataFrame:
    """(key, cuts): per text the map from block to the places that go; overlapping spans are one."""
    live = found.groupBy("key").agg(F.first("found").alias("found")).select("key", F.explode(F.filter("found", lambda s: s["live"])).alias("s"))
    order = Window.partitionBy("key").orderBy("s.start", "s.end")
    before = F.max("s.end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    apart = live.withColumn("new", F.coalesce((F.col("s.start") >= before).cast("int"), F.lit(1)))
    runs = apart.withColumn("run", F.sum("new").over(order)).groupBy("key", "run").agg(F.min("s.start").alias("start"), F.max("s.end").alias("end"))
    numbers = F.sequence(F.floor(F.col("start") / CHARS).cast("int"), F.floor((F.col("end") - 1) / CHARS).cast("int"))
    in_block = runs.withColumn("block", F.explode(numbers))
    begin = F.col("block") * CHARS
    cut = F.struct(
        F.greatest(F.col("start") - begin, F.lit(0)).alias("lo"), F.least(F.col("end") - begin, F.lit(CHARS)).alias("hi"), (F.col("start") >= begin).alias("head"),
    )
    blocks = in_block.groupBy("key", "block").agg(F.array_sort(F.collect_list(cut)).alias("cuts"))
    return blocks.groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("block", "cuts"))).alias("cuts"))


def redact_secrets(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_chars_col: str | None = "n_chars", **options,
) -> DataFrame:
    """``df`` with the spans that look live replaced by a placeholder; all columns and rows stay."""
    cuts = _cuts(scan_secrets(df, id_col, text_col, **options).filter("n_live > 0"))
    rows = whole_rows(df, key=F.xxhash64(F.col(id_col), text_of(text_col)), text=text_of(text_col))
    met = rows.join(cuts, "key", "left")
    blocks = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{CHARS}}}"), F.lit(0))
    pieces = F.transform(blocks, lambda b, i: F.when(F.col("cuts")[i].isNull(), b).otherwise(_cut(b, F.col("cuts")[i])))
    met = met.withColumn("new", F.when(F.col("cuts").isNotNull(), F.array_join(pieces, "")))
    columns = {c: F.col(f"row.{quoted(c)}") for c in df.columns}
    columns[text_col] = F.coalesce("new", columns[text_col])
    if n_chars_col in df.columns:
        columns[n_chars_col] = F.when(F.col("new").isNotNull(), F.length("new").cast(df.schema[n_chars_col].dataType)).otherwise(columns[n_chars_col])
    return met.select(*[c.alias(name) for name, c in columns.items()])
