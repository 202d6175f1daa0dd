"""Near-duplicate detection by fast similarity sketching.

A document's set is its distinct word shingles (64-bit hashes of all words of
a shingle). Its sketch has ``BANDS * BAND_ROWS`` coordinates, filled in rounds:
round r hashes every element to a bin and keeps the least value of each bin,
values of later rounds lying above those of earlier ones; from round t on
(t coordinates) round r fills bin r - t with the least value of the whole set.
So rounds stop as soon as every coordinate is filled, each coordinate is
guaranteed to fill, and agreement between two sketches is concentrated about
the Jaccard similarity like that of sampling without replacement.

1. Documents with the same set form one class (``full`` is a 128-bit digest);
   from here on only classes matter, so copies make no pairs.
2. Banding: classes that share a band are candidates. A group of very many
   near copies would make a square of pairs, so groups are resolved in rounds
   of stars: each group picks one leader, the member that shares most with
   others, and only leader-member pairs are verified. Members that are linked
   are merged into components; a group whose members lie in one component has
   nothing left to find and takes no further part.
3. After ``STAR_ROUNDS`` rounds, the groups that are still in several
   components have all their remaining pairs between different components
   verified, so no link between components is lost. Up to ``SMALL_GROUP``
   members that is a join (at most that many pairs a member); larger groups
   are cut into blocks of members, each pair of blocks is compared on the full
   sets inside one task, and only links that merge components leave the task.
4. A candidate pair is dropped before verification only if its sketches agree
   in so few coordinates that a linked pair would show it with probability
   below 1e-9, or if the set sizes alone rule the link out. All others are
   verified on the full sets, which are made again for the documents that
   take part.

A pair at the threshold (0.85) misses every band with probability 7.6e-7.

Null and empty texts have an empty set and no links, and are their own
component. A text of fewer words than a shingle has one shingle. Repeated
rows with the same id get the same result each; rows with a null id get null
as component unless linked to a row with an id. An empty input gives an empty
result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaybook.llm.common import pick, prepare
from quaybook.llm.components import component_labels
from quaybook.llm.sieve import parted
from quaybook.plans.stages import drop_stage, write_stage

SHINGLE = 5
LINK = (100, 85)  # linked: 100 * intersection >= 85 * union
BANDS, BAND_ROWS = 24, 5
T = BANDS * BAND_ROWS
#: A pair linked at 0.85 agrees in fewer coordinates with probability < 1e-9
#: (binomial tail; sampling without replacement is tighter).
LEAST_AGREEMENT = 74
STAR_ROUNDS = 2
SMALL_GROUP = 32
BLOCK_MEMBERS, BLOCK_SHINGLES = 1_024, 2_000_000  # of a block, about
BLOCK_BYTES = 1 << 19  # texts are hashed this much at a time

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_BYTE = np.random.Generator(np.random.PCG64(20240501)).integers(1, 2**64, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_POWERS = {}


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mixer of 64-bit values (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept for later blocks."""
    have = _POWERS.get(int(base))
    if have is None or len(have) < n:
        have = np.ones(max(n, BLOCK_BYTES), dtype=np.uint64)
        have[1:] = base
        have = _POWERS[int(base)] = np.cumprod(have, dtype=np.uint64)
    return have[:n]


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of every word of a block of bytes. A word's hash is a
    polynomial over random values of its bytes, from prefix sums."""
    data = _LOWER[data]
    space = _SPACE[data]
    border = np.flatnonzero(np.diff(np.concatenate(([True], space, [True])).astype(np.int8)))
    starts, ends = border[::2], border[1::2]
    sums = np.concatenate((np.zeros(1, dtype=np.uint64),
                           np.cumsum(_BYTE[data] * _powers(_BASE, len(data)), dtype=np.uint64)))
    at_zero = (sums[ends] - sums[starts]) * _powers(_INVERSE, len(data) + 1)[starts]
    return mixed(at_zero + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)), starts


def shingle_sets(texts: list[bytes], size: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    joined = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    words, starts = word_hashes(joined)
    text_ends = np.cumsum([len(t) + 1 for t in texts])
    cut = np.searchsorted(starts, text_ends)
    first = np.concatenate(([0], cut[:-1]))
    n = max(len(words) - size + 1, 0)
    runs = np.zeros(n, dtype=np.uint64)
    for i in range(size):
        runs = mixed(runs * _BASE + words[i:i + n])
    out = []
    for a, b in zip(first, cut, strict=True):
        if b - a >= size:
            out.append(np.unique(runs[a:b - size + 1]))
        elif b > a:
            value = np.zeros(1, dtype=np.uint64)
            for w in words[a:b]:
                value = mixed(value * _BASE + w)
            out.append(mixed(value + np.uint64(b - a)))  # told apart from whole shingles
        else:
            out.append(np.empty(0, dtype=np.uint64))
    return out


def sketches(sets: list[np.ndarray], t: int = T) -> np.ndarray:
    """One row of t coordinates per set; sets must not be empty."""
    out = np.full((len(sets), t), np.iinfo(np.uint64).max, dtype=np.uint64)
    if not sets:
        return out
    flat = out.reshape(-1)
    todo = np.arange(len(sets))
    size = np.array([len(s) for s in sets])
    values = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), size)
    for r in range(2 * t):
        h = mixed(values + np.uint64((r + 1) * 0xA0761D6478BD642F % 2**64))
        # The round in the top bits: later rounds never replace earlier values.
        value = (np.uint64(r) << np.uint64(54)) | (h >> np.uint64(10))
        place = (mixed(h) % np.uint64(t)).astype(np.int64) if r < t else np.full(len(h), r - t)
        np.minimum.at(flat, owner * t + place, value)
        todo = todo[(out[todo] == np.iinfo(np.uint64).max).any(axis=1)]
        if not len(todo):
            break
        if len(todo) < len(sets):
            stays = np.zeros(len(sets), dtype=bool)
            stays[todo] = True
            keep = stays[owner]
            values, owner = values[keep], owner[keep]
    return out


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[bytes]]]:
    """(keys, UTF-8 texts) of bounded size; a longer text comes alone."""
    keys, texts, held = [], [], 0
    for batch in batches:
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), strict=True):
            data = text.as_py() or b""
            if texts and held + len(data) > BLOCK_BYTES:
                yield keys, texts
                keys, texts, held = [], [], 0
            keys.append(key)
            texts.append(data)
            held += len(data)
    if texts:
        yield keys, texts


def sketch_documents(rows: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, full, bands, low, key) of rows (doc_id, text): the
    digest of the set, a hash per band, the low byte of each coordinate, and
    the digest of the text."""
    from pyspark.sql.pandas.types import to_arrow_type

    id_type = rows.schema["doc_id"].dataType
    arrow_id = to_arrow_type(id_type)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = mixed(np.arange(1, BAND_ROWS + 1, dtype=np.uint64))
        for ids, texts in _blocks(batches):
            sets = shingle_sets(texts)
            some = [i for i, s in enumerate(sets) if len(s)]
            rows_of = sketches([sets[i] for i in some])
            grouped = mixed(rows_of.reshape(-1, BANDS, BAND_ROWS) * (weights | np.uint64(1))).sum(axis=2, dtype=np.uint64)
            bands = mixed(grouped + np.arange(BANDS, dtype=np.uint64)).view(np.int64)
            low = (mixed(rows_of) & np.uint64(0xFF)).astype(np.uint8)
            bands_of, low_of = dict(zip(some, bands, strict=True)), dict(zip(some, low, strict=True))
            yield pa.RecordBatch.from_arrays([
                pa.array(ids, arrow_id), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets], pa.binary()),
                pa.array([bands_of[i].tolist() if i in bands_of else None for i in range(len(sets))], pa.list_(pa.int64())),
                pa.array([low_of[i].tobytes() if i in low_of else None for i in range(len(sets))], pa.binary()),
                pa.array([hashlib.md5(t, usedforsecurity=False).digest() for t in texts], pa.binary())],
                names=["doc_id", "n_shingles", "full", "bands", "low", "key"])

    return rows.mapInArrow(sketch, f"doc_id {id_type.simpleString()}, n_shingles long, full binary, "
                                   "bands array<long>, low binary, key binary")


def _set_rows(rows: DataFrame) -> DataFrame:
    """(cls, full_set) of rows (cls, text)."""
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts in _blocks(batches):
            sets = [s.view(np.int64).tobytes() for s in shingle_sets(texts)]
            yield pa.RecordBatch.from_arrays([
                pa.array(keys, pa.int64()), pa.array(sets, pa.binary()),
                pa.array([hashlib.blake2b(s, digest_size=16).digest() for s in sets], pa.binary())],
                names=["cls", "full_set", "full"])

    made = rows.select("cls", "text").mapInArrow(make, "cls long, full_set binary, full binary")
    return made.where(F.xxhash64("full") == F.col("cls")).select("cls", "full_set")


def _filtered(pairs: DataFrame, info: DataFrame) -> DataFrame:
    """Adds what both ends have and drops the pairs that can't be links.
    ``pairs``: (a, b); result: those (a, b) whose sketches agree enough."""
    def agree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = np.frombuffer(b"".join(batch.column(2).to_pylist()), dtype=np.uint8).reshape(-1, T)
                y = np.frombuffer(b"".join(batch.column(3).to_pylist()), dtype=np.uint8).reshape(-1, T)
                enough = pa.array((x == y).sum(axis=1) >= LEAST_AGREEMENT)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(enough)

    both = (pairs.join(info.select(F.col("cls").alias("a"), F.col("low").alias("la"), F.col("n_shingles").alias("na")), "a")
            .join(info.select(F.col("cls").alias("b"), F.col("low").alias("lb"), F.col("n_shingles").alias("nb")), "b")
            .where(LINK[0] * F.least("na", "nb") >= LINK[1] * F.greatest("na", "nb")))
    return both.select("a", "b", "la", "lb").mapInArrow(agree, "a long, b long")


def _verified(pairs: DataFrame, sources: DataFrame) -> DataFrame:
    """The pairs (a, b) that are links on their full sets. ``sources``: one
    (cls, text) per class. Each set is made once and shuffled to its pairs."""
    pairs = write_stage(pairs, "pairs")
    taking = write_stage(pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct(), "taking")
    sets = write_stage(_set_rows(sources.join(taking, "cls", "left_semi")), "sets")

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(x.as_buffer(), dtype=np.int64), np.frombuffer(y.as_buffer(), dtype=np.int64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(LINK[0] * common >= LINK[1] * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    full = (pairs.join(sets.select(F.col("cls").alias("b"), F.col("full_set").alias("fb")), "b")
            .join(sets.select(F.col("cls").alias("a"), F.col("full_set").alias("fa")), "a"))
    links = write_stage(full.select("a", "b", "fa", "fb").mapInArrow(linked, "a long, b long"), "links")
    for done in (pairs, taking, sets):
        drop_stage(done)
    return links


def _block_links(big: DataFrame, info: DataFrame, sources: DataFrame) -> DataFrame:
    """Links (a, b) that merge components of large groups. ``big``: (band,
    bucket, cls, comp, parts); a pair is compared in its first common band."""
    big = write_stage(big, "big")
    taking = big.select("cls").distinct()
    sets = write_stage(_set_rows(sources.join(taking, "cls", "left_semi")), "sets")
    rows = (big.join(info.select("cls", "low", "bands", "n_shingles"), "cls").join(sets, "cls")
            .withColumn("part", F.pmod(F.xxhash64("cls", "band"), F.col("parts")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
            .withColumn("i", F.least("part", "other")).withColumn("j", F.greatest("part", "other")))
    columns = ("band", "bucket", "i", "j", "part", "cls", "comp", "n_shingles", "low", "bands", "full_set")
    found = rows.select(*columns).groupBy("band", "bucket", "i", "j").applyInPandas(_compare_blocks, "a long, b long")
    links = write_stage(found, "links")
    drop_stage(sets)
    return links


def _compare_blocks(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """The links between two blocks of one group (or inside one, i = j) that
    merge components, each by exact intersection of the full sets."""
    band, i, j = int(key[0]), int(key[2]), int(key[3])
    rows = rows.drop_duplicates("cls").sort_values("cls")
    cls, comp = rows["cls"].to_numpy(), rows["comp"].to_numpy()
    size, part = rows["n_shingles"].to_numpy(), rows["part"].to_numpy()
    low = np.frombuffer(b"".join(rows["low"]), dtype=np.uint8).reshape(-1, T)
    bands = np.stack([np.asarray(b, dtype=np.int64) for b in rows["bands"]])
    values, codes = np.unique(np.concatenate([np.frombuffer(s, dtype=np.int64) for s in rows["full_set"]]), return_inverse=True)
    codes = np.split(codes, np.cumsum(size)[:-1])
    _, comp = np.unique(comp, return_inverse=True)  # merged as links are found
    has = np.zeros(len(values), dtype=bool)
    right = np.flatnonzero(part == j)
    links = []
    for x in np.flatnonzero(part == i):
        y = right[right > x] if i == j else right
        y = y[(comp[y] != comp[x]) & (LINK[0] * np.minimum(size[y], size[x]) >= LINK[1] * np.maximum(size[y], size[x]))]
        y = y[(low[y] == low[x]).sum(axis=1) >= LEAST_AGREEMENT]
        y = y[(bands[y] == bands[x]).argmax(axis=1) == band]
        if not len(y):
            continue
        has[codes[x]] = True
        common = np.add.reduceat(has[np.concatenate([codes[k] for k in y])].astype(np.int64),
                                 np.concatenate(([0], np.cumsum(size[y])[:-1])))
        has[codes[x]] = False
        for k in y[LINK[0] * common >= LINK[1] * (size[x] + size[y] - common)]:
            if comp[k] != comp[x]:
                comp[comp == comp[k]] = comp[x]
                links.append((min(cls[x], cls[k]), max(cls[x], cls[k])))
    return pd.DataFrame(links, columns=["a", "b"]).astype("int64")


def _unresolved(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    """The (band, bucket, cls, comp, popular) rows of groups that lie in more
    than one component."""
    if labels is None:
        return members.withColumn("comp", F.col("cls"))
    now = (members.join(labels.select(F.col("node").alias("cls"), F.col("component")), "cls", "left")
           .withColumn("comp", F.coalesce("component", "cls")).drop("component"))
    open_groups = (now.groupBy("band", "bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
                   .where("lo < hi").select("band", "bucket"))
    return now.join(open_groups, ["band", "bucket"], "left_semi")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row."""
    return _result(*_labelled(docs, id_col, text_col))


def _labelled(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """(the sketch of every row, the classes, the component of linked classes)."""
    prepare(docs.sparkSession)
    rows = pick(docs, doc_id=id_col, text=text_col)
    made = write_stage(sketch_documents(rows), "sketches")
    # A class is named by the hash of its digest; equal names of different
    # digests would take 2**32 classes to be likely, so the digest is kept.
    classes = made.where("full IS NOT NULL").withColumn("cls", F.xxhash64("full"))
    # The row that a class's text is taken from: the least named id, or none if
    # all lack one, and of its texts in the class the least digest.
    source = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "key")).alias("source")
    info = write_stage(classes.groupBy("cls").agg(
        F.min("doc_id").alias("least_id"), source, F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"),
        F.first("low").alias("low")), "classes")
    groups = info.select("cls", F.posexplode("bands").alias("band", "bucket"))
    shared = groups.groupBy("band", "bucket").agg(F.count("*").alias("size")).where("size > 1")
    members = write_stage(groups.join(shared, ["band", "bucket"]), "band-members")
    popular = members.groupBy("cls").agg(F.sum("size").alias("popular"))
    members = write_stage(members.join(popular, "cls").drop("size"), "members")
    # One text of each class that shares a band, to make sets from: joined by id
    # and digest, as many rows may share an id or lack one (a struct of both is
    # equal where both ids are null). Other texts stay where they lie, and
    # repeated rows are reduced to one before they leave their task.
    name = F.struct("doc_id", "key").alias("name")
    wanted = write_stage(members.select("cls").distinct().join(info.select("cls", "source"), "cls")
                         .select("cls", "source.doc_id", "source.key"), "wanted")
    keyed = rows.withColumn("key", F.unhex(F.md5(F.coalesce("text", F.lit("")))))
    _, near = parted(keyed, ["doc_id", "key"], wanted)
    sources = write_stage(near.groupBy(name).agg(F.first("text").alias("text"))
                          .join(wanted.select(name, "cls"), "name").select("cls", "text"), "sources")
    links, labels, tried = None, None, None
    for r in range(STAR_ROUNDS + 1):
        left = write_stage(_unresolved(members, labels), "open")
        new = []
        if r < STAR_ROUNDS:
            pairs = _star_pairs(left, r)
        else:
            sized = left.join(info.select("cls", "n_shingles"), "cls").groupBy("band", "bucket").agg(
                F.count("*").alias("size"), F.sum("n_shingles").alias("shingles"))
            left = left.join(sized, ["band", "bucket"])
            parts = F.ceil(F.greatest(F.col("size") / BLOCK_MEMBERS, F.col("shingles") / BLOCK_SHINGLES)).cast("int")
            new.append(_block_links(left.where(F.col("size") > SMALL_GROUP).select(
                "band", "bucket", "cls", "comp", parts.alias("parts")), info, sources))
            left = left.where(F.col("size") <= SMALL_GROUP)
            x, y = left.alias("x"), left.alias("y")
            pairs = (x.join(y, ["band", "bucket"]).where("x.comp < y.comp")
                     .select(F.least("x.cls", "y.cls").alias("a"), F.greatest("x.cls", "y.cls").alias("b")))
        pairs = pairs.distinct()
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = write_stage(pairs, "candidates")
        if not pairs.isEmpty():
            tried = pairs if tried is None else tried.union(pairs)
            new.append(_verified(_filtered(pairs, info), sources))
        for found in new:
            links = found if links is None else links.union(found)
        if new:
            labels = write_stage(component_labels(links.select(F.col("a").alias("u"), F.col("b").alias("v"))), "labels")
    drop_stage(sources)
    return made, info, labels


def _star_pairs(left: DataFrame, r: int) -> DataFrame:
    """(a, b) of each group's leader and the members of other components. The
    leader is the member that shares most; in later rounds the one that does
    among those outside the component of the round before's."""
    best = left.groupBy("band", "bucket").agg(
        F.max(F.struct("popular", F.xxhash64("cls", F.lit(r)).alias("tie"), "cls", "comp")).alias("lead"))
    pairs = left.join(best, ["band", "bucket"]).where(F.col("comp") != F.col("lead.comp"))
    if r:
        others = pairs.groupBy("band", "bucket").agg(
            F.max(F.struct("popular", F.xxhash64("cls", F.lit(r)).alias("tie"), "cls", "comp")).alias("lead2"))
        again = left.join(others, ["band", "bucket"]).where(F.col("comp") != F.col("lead2.comp"))
        pairs = (pairs.select("cls", F.col("lead.cls").alias("leader"))
                 .union(again.select("cls", F.col("lead2.cls").alias("leader"))))
    else:
        pairs = pairs.select("cls", F.col("lead.cls").alias("leader"))
    return pairs.select(F.least("cls", "leader").alias("a"), F.greatest("cls", "leader").alias("b"))


def _result(made: DataFrame, info: DataFrame, labels: DataFrame | None) -> DataFrame:
    rows = made.select("doc_id", "n_shingles", F.xxhash64("full").alias("cls"), F.col("full").isNull().alias("alone"))
    named = info.select("cls", "least_id")
    if labels is not None:
        named = named.join(labels.withColumnRenamed("node", "cls"), "cls", "left").withColumn("component", F.coalesce("component", "cls"))
        least = named.groupBy("component").agg(F.min("least_id").alias("component_id"))
        named = named.join(least, "component").select("cls", "component_id")
    else:
        named = named.select("cls", F.col("least_id").alias("component_id"))
    named = write_stage(named, "components")
    out = rows.join(named, (rows["cls"] == named["cls"]) & ~rows["alone"], "left").withColumn(
        "component_id", F.when(F.col("alone"), F.col("doc_id")).otherwise(F.col("component_id")))
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def keep_one_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all their columns, that stay: one of each component
    of texts, whatever the ids. It has the component's least id (null only if
    all are) and, of the texts with that id, the least digest. Texts without a
    shingle are in no component; of repeated rows with the same id and text,
    one stays."""
    made, info, labels = _labelled(docs, id_col, text_col)
    # By class first: a large group of copies is one row before any shuffle.
    classes = info.select("cls", F.col("source").alias("least"), F.col("cls").alias("component"))
    if labels is not None:
        classes = (classes.drop("component").join(labels.withColumnRenamed("node", "cls"), "cls", "left")
                   .withColumn("component", F.coalesce("component", "cls")))
    best = classes.groupBy("component").agg(F.min("least").alias("least"))
    stays = classes.select("cls", "component").join(best, "component").select("cls", "least.doc_id", "least.key")
    mine, theirs = F.struct("m.doc_id", "m.key"), F.struct("s.doc_id", "s.key")
    # Only small rows (id, digest) decide; texts that neither go nor are
    # repeated stay where they lie, however long the list.
    goes = write_stage(made.where("full IS NOT NULL").select("doc_id", "key", F.xxhash64("full").alias("cls")).alias("m")
                       .join(stays.alias("s"), F.col("m.cls") == F.col("s.cls")).where(~mine.eqNullSafe(theirs))
                       .select("m.doc_id", "m.key").distinct(), "goes")
    again = write_stage(made.groupBy("doc_id", "key").agg(F.count("*").alias("n")).where("n > 1").select("doc_id", "key"), "repeated")
    # Rows travel as one struct, so no column can clash with those added.
    whole = docs.select(docs[id_col].alias("doc_id"), F.unhex(F.md5(F.coalesce(docs[text_col], F.lit("")))).alias("key"),
                        F.struct("*").alias("row"))
    same = [F.col("w.doc_id").eqNullSafe(F.col("o.doc_id")), F.col("w.key") == F.col("o.key")]
    clear, rest = parted(whole, ["doc_id", "key"], goes.union(again))
    left = rest.alias("w").join(goes.alias("o"), same, "left_anti")
    if again.isEmpty():
        return clear.union(left).select("row.*")
    once = left.alias("w").join(again.alias("o"), same, "left_anti")
    more = left.alias("w").join(again.alias("o"), same, "left_semi").groupBy("doc_id", "key").agg(
        F.min_by("row", F.to_json("row")).alias("row"))
    return clear.union(once).union(more).select("row.*")
