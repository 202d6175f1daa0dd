"""Benchmark decontamination by winnowed fingerprints, in DataFrame functions.

Words are compared as they are after lower-casing A-Z. A span of ``window``
words that a document shares with an item holds ``window - k + 1`` k-grams in
a row; on both sides the smallest k-gram hash of every such run is kept, so
every shared span of at least ``window`` words shares a kept fingerprint.

1. Each text is cut into words, its k-gram hashes come from
   pairwise combinations (k doubles at each step) and the smallest of each run
   from pairwise minimums. Kept fingerprints of documents are joined to those
   of the items. The items' table is written first, so the planner knows its
   size: it broadcasts a small one and shuffles a large one.
2. Texts with a hit are looked at again: every position of a hit k-gram is
   joined to the item's positions, which gives the diagonals (text, item,
   shift) to look at.
3. A hit is extended over its whole diagonal: words of text and item are
   compared once each, the places where they differ are listed, and each run of
   at least ``window`` equal words between them marks its words as hit; the
   work grows with the diagonal. Hash collisions end here: only equal words
   count.

An item of fewer than ``window`` words is a window of its own length n: for
each such n all n-grams are fingerprints (k = n, runs of 1).

Hits are extended once per distinct text, whatever the number of copies, and
results are joined back to the rows. Null and empty texts (of documents or
items) have no words; items without an id are named by the empty string.
Repeated rows, null ids and extra columns are kept as
they are; without items nothing is hit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quaybook.llm.common import ascii_lower, pick, prepare
from quaybook.llm.sieve import parted
from quaybook.plans.stages import new_stage_path, write_stage

WINDOW = 13
GRAM = 8
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
RATIO = 20  # contaminated: at least one word in so many is hit


def words_of(text: Column) -> Column:
    """The words of a text; none for null."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), NOT_WORD), "")


def _shifted(a: Column, by: int) -> Column:
    return F.slice(a, by + 1, F.greatest(F.size(a) - by, F.lit(0)))


def _paired(a: Column, by: int, combine) -> Column:
    """combine(a[i], a[i + by]) for every i that has both."""
    return F.zip_with(F.slice(a, 1, F.greatest(F.size(a) - by, F.lit(0))), _shifted(a, by), combine)


def _steps(n: int) -> list[int]:
    """Shifts that widen a run of 1 to n, at most doubling it each time."""
    shifts, width = [], 1
    while width < n:
        shifts.append(min(width, n - width))
        width += shifts[-1]
    return shifts


def with_grams(df: DataFrame, words: str, k: int, out: str) -> DataFrame:
    """Adds hashes of all runs of k words. A run is hashed from two shorter
    ones that cover it."""
    df = df.withColumn(out, F.transform(words, lambda w: F.xxhash64(w)) if k == 1 else F.col(words))
    for shift in _steps(k):
        df = df.withColumn(out, _paired(F.col(out), shift, lambda a, b: F.xxhash64(a, b)))
    return df


def with_least(df: DataFrame, values: str, run: int, out: str) -> DataFrame:
    """Adds the distinct minimums of all runs of so many values."""
    df = df.withColumn(out, F.col(values))
    for shift in _steps(run):
        df = df.withColumn(out, _paired(F.col(out), shift, lambda a, b: F.least(a, b)))
    return df.withColumn(out, F.array_distinct(out))


def _profiles(items: DataFrame, window: int, gram: int) -> list[tuple[int, int, Column]]:
    """(k, run, which items) for long items and for each shorter length that
    occurs; at most ``window`` entries come to the driver."""
    n = F.col("n_item")
    short = sorted(r.n_item for r in items.where(n < window).select("n_item").distinct().collect())
    return [(gram, window - gram + 1, n >= window)] + [(k, 1, n == k) for k in short]


def _spots(items: DataFrame, k: int) -> DataFrame:
    """(gram, item_id, at) of every k-gram of the items. Of a plain explode
    the planner infers a filter on the array, which it pushes below the steps
    that make it, written out many times over; of an outer one it doesn't."""
    return (with_grams(items, "item_words", k, "grams")
            .select("item_id", F.posexplode_outer("grams").alias("at", "gram")).where("gram IS NOT NULL"))


def _covered(texts: DataFrame, items: DataFrame, spots: DataFrame, marks: DataFrame, grams: DataFrame,
             window: int, k: int) -> DataFrame:
    """(text_key, item_id, start, end) of the runs of words of the texts that
    are occurrences of windows of one of the items. ``grams``: (text_key, gram)
    that both sides kept, of those in ``marks``; each is extended over its
    diagonal. Of the texts' many k-grams, the few that are marked at all are
    found first, so that only these travel."""
    places = (with_grams(texts, "words", k, "grams").select("text_key", F.posexplode_outer("grams").alias("pos", "gram"))
              .where("gram IS NOT NULL").join(marks, "gram", "left_semi").join(grams, ["text_key", "gram"], "left_semi"))
    diagonals = write_stage(places.join(spots, "gram").select(
        "text_key", "item_id", (F.col("pos") - F.col("at")).alias("shift")).distinct(), "diagonals")
    size = F.least(F.col("n_item"), F.lit(window))
    # The part of the item that lies inside the text on this diagonal.
    first = F.greatest(-F.col("shift"), F.lit(0))
    span = F.least(F.col("n_item"), F.size("words") - F.col("shift")) - first
    # Where text and item differ on the diagonal. It is written out: as a plan
    # it would be put into every expression that looks at it.
    lined = write_stage(
        diagonals.join(items, "item_id").join(texts, "text_key")
        .withColumns({"first": first, "span": span, "size": size}).where("span >= size")
        .select("text_key", "item_id", "size", "span", (F.col("first") + F.col("shift")).alias("place"),
                F.filter(F.sequence(F.lit(0), F.col("span") - 1), lambda i: F.get("item_words", F.col("first") + i)
                         != F.get("words", F.col("first") + F.col("shift") + i)).alias("unequal")), "lined")
    # Runs of equal words lie between neighbouring differences.
    runs = F.zip_with(F.concat(F.array(F.lit(-1)), "unequal"), F.concat("unequal", F.array("span")),
                      lambda a, b: F.struct((a + 1).alias("start"), (b - a - 1).alias("n")))
    long_runs = F.filter(runs, lambda r: r["n"] >= F.col("size"))
    return (lined.select("text_key", "item_id", "place", F.explode_outer(long_runs).alias("run")).where("run IS NOT NULL")
            .select("text_key", "item_id", (F.col("place") + F.col("run.start")).alias("start"),
                    (F.col("place") + F.col("run.start") + F.col("run.n")).alias("end")))


def _covered_words(spans: DataFrame) -> DataFrame:
    """(text_key, n_hit): how many words lie in a span (start to before end)
    of the text. In the order of their starts, a span adds what lies behind
    the furthest end so far; no word is listed by itself."""
    before = Window.partitionBy("text_key").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.greatest(F.col("end") - F.greatest(F.col("start"), F.coalesce(F.max("end").over(before), F.lit(0))), F.lit(0))
    return (spans.select("text_key", "start", "end").distinct().select("text_key", fresh.alias("fresh"))
            .groupBy("text_key").agg(F.sum("fresh").alias("n_hit")))


def document_hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM,
                  ratio: int = RATIO, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, text_key (digest of its text), n_words,
    n_hit, items (ids of the items with occurring windows, sorted as strings)
    and contaminated."""
    prepare(docs.sparkSession)
    items = write_stage(pick(benchmark, item_id=item_col, item_text=item_text_col)
                        .select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), words_of(F.col("item_text")).alias("item_words"))
                        .distinct().withColumn("n_item", F.size("item_words")).where("n_item > 0"), "items")
    profiles = _profiles(items, window, gram)
    rows = pick(docs, doc_id=id_col, text=text_col).withColumn(
        "text_key", F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)))
    marked = rows.withColumn("words", words_of(F.col("text")))
    for i, (k, run, _) in enumerate(profiles):
        marked = with_least(with_grams(marked, "words", k, "grams"), "grams", run, f"kept{i}")
    marked = write_stage(marked.select("doc_id", "text_key", F.size("words").cast("long").alias("n_words"),
                                       *[f"kept{i}" for i in range(len(profiles))]), "marked")
    # Each length appends its hits to one table, so no plan holds them all.
    covered = new_stage_path(docs.sparkSession, "covered")
    for i, (k, run, which) in enumerate(profiles):
        chosen = items.where(which)
        marks = write_stage(with_least(with_grams(chosen, "item_words", k, "grams"), "grams", run, "kept")
                            .select(F.explode_outer("kept").alias("gram")).where("gram IS NOT NULL").distinct(), "marks")
        grams = write_stage(marked.select("text_key", F.explode(f"kept{i}").alias("gram"))
                            .join(marks, "gram", "left_semi").distinct(), "hit-grams")
        keys = write_stage(grams.select("text_key").distinct(), "hit-keys")
        texts = write_stage(parted(rows, ["text_key"], keys)[1].join(keys, "text_key", "left_semi").dropDuplicates(["text_key"])
                            .select("text_key", words_of(F.col("text")).alias("words")), "hit-texts")
        spots = write_stage(_spots(chosen, k).join(marks, "gram", "left_semi"), "spots")
        part = _covered(texts, items, spots, marks, grams, window, k)
        part.write.mode("append").parquet(covered)
    hits = docs.sparkSession.read.schema(part.schema).parquet(covered)
    counts = _covered_words(hits)
    named = hits.select("text_key", "item_id").distinct().groupBy("text_key").agg(
        F.array_sort(F.collect_list("item_id")).alias("items"))
    found = write_stage(counts.join(named, "text_key"), "found")
    return (marked.select("doc_id", "text_key", "n_words").join(found, "text_key", "left")
            .select("doc_id", "text_key", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                    F.coalesce("items", F.array().cast("array<string>")).alias("items"))
            .withColumn("contaminated", (F.col("n_hit") > 0) & (ratio * F.col("n_hit") >= F.col("n_words"))))


def clean_documents(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, all their columns, whose texts aren't contaminated."""
    found = document_hits(docs, benchmark, text_col=text_col, **options)
    bad = write_stage(found.where("contaminated").select("text_key").distinct(), "contaminated")
    # Rows travel as one struct, so no column can clash with those added.
    whole = docs.select(F.unhex(F.sha2(F.coalesce(docs[text_col], F.lit("")), 256)).alias("text_key"), F.struct("*").alias("row"))
    clear, rest = parted(whole, ["text_key"], bad)
    return clear.union(rest.join(bad, "text_key", "left_anti")).select("row.*")
