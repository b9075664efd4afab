"""MinHash near-dedup: consistent weighted samples of TF-IDF shingles, banded, verified by weighted Jaccard similarity."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import LAST_ID, cut, order_id, text_key
from tidemark.llm.components import components
from tidemark.llm.words import Words, chunks, hash_words, mix, shingles

THRESHOLD = 0.8
BANDS, ROWS = 16, 4
#: Document frequencies are counted in so many buckets of shingle hashes.
DF_BITS = 18
#: Shingles of less than this share of the documents have the full weight, at every size of the table: near copies that are
#: a third of it are compared as if they were few. So do those of fewer than FEW documents, as a small table tells nothing.
RARE, FEW = 0.5, 1000
#: Texts and shingles of a block, about: so many of two blocks are in a task's memory when they are compared with each other.
BLOCK_NODES, BLOCK_SHINGLES = 256, 1 << 20
#: Shingles of the lists that texts of a block are looked up in at a time.
TILE = 1 << 18
#: Bytes of text that are hashed at a time, and what Spark hands to Python at a time: long texts must not add up there.
PART = 1 << 19
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": str(1 << 22)}
#: Shuffle files of a job go when it ends, not when the driver happens to collect its garbage.
CLEANUP = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
#: Members of a hub that one task compares with it.
SLICE = 256
#: Bits that mark the texts which are asked for again: at most 2**17 words of 64 bits are broadcast.
MARK_BITS = 23
TABLE_BITS = 12
BLOCK = 4096


def _draws() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gamma(2, 1), log of Gamma(2, 1) and uniform draws that shingles look up by bits of their hash."""
    random = np.random.default_rng(2010)
    shape = (1 << TABLE_BITS, BANDS * ROWS)
    rate = random.gamma(2.0, 1.0, shape).astype(np.float32) + np.float32(1e-6)
    return rate, np.log(random.gamma(2.0, 1.0, shape)).astype(np.float32), random.random(shape, dtype=np.float32)


RATE, LOG_C, BETA = _draws()
#: The part of the sampling value that a weight of one needs.
UNIT = RATE * (BETA - 1)
_TABLE = np.uint64((1 << TABLE_BITS) - 1)


def sample_weighted(hashes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Improved consistent weighted sampling: BANDS * ROWS samples of a weighted set, each a hash of element and level.

    Two sets get the same sample with the probability of their weighted Jaccard similarity. hashes are sorted and differ.
    Two sets of hash bits choose the draws, so elements that share one of them still differ in the other.
    """
    best = level = chosen = None
    columns = np.arange(BANDS * ROWS)
    for at in range(0, len(hashes), BLOCK):
        part, weight = hashes[at : at + BLOCK], weights[at : at + BLOCK]
        row, other = (part & _TABLE).astype(np.int64), (part >> np.uint64(TABLE_BITS) & _TABLE).astype(np.int64)
        value = LOG_C[other] + UNIT[row]
        odd = np.flatnonzero(weight != 1)
        steps = None
        if len(odd):
            rate, beta = RATE[row[odd]], BETA[row[odd]]
            steps = np.floor(np.log(weight[odd]).astype(np.float32)[:, None] / rate + beta)
            value[odd] = LOG_C[other[odd]] - rate * (steps - beta + 1)
        least = value.argmin(axis=0)
        low = value[least, columns]
        where = np.zeros(len(columns), dtype=np.int64)
        if steps is not None:
            place = np.full(len(part), -1)
            place[odd] = np.arange(len(odd))
            hit = place[least]
            where = np.where(hit >= 0, steps[hit, columns], 0).astype(np.int64)
        if best is None:
            best, level, chosen = low, where, part[least]
        else:
            better = low < best
            best, level, chosen = np.where(better, low, best), np.where(better, where, level), np.where(better, part[least], chosen)
    return mix(chosen + mix(level.astype(np.uint64) + np.uint64(7)))


def band_keys(samples: np.ndarray) -> np.ndarray:
    rows = samples.reshape(BANDS, ROWS)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for k in range(ROWS):
        key = mix(key + rows[:, k])
    return key.view(np.int64)


def _weighted(hashes: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles and their weights: 1 + log of the count, times the weight of the shingle."""
    unique, counts = np.unique(hashes, return_counts=True)
    return unique, (1 + np.log(counts)) * idf[(unique >> np.uint64(64 - DF_BITS)).astype(np.int64)]


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    shared = np.minimum(a[1][i], b[1][j]).sum()
    whole = a[1].sum() + b[1].sum() - shared
    return float(shared / whole) if whole else 0.0


def links_between(sets: list[tuple[np.ndarray, np.ndarray]], block: np.ndarray, roots: list, threshold: float) -> list[tuple[int, int]]:
    """Pairs of sets of threshold similarity that join different classes: enough of them to connect all that such pairs connect.

    block has one or two values; within one all pairs are looked at, else those between the two. What sets share is summed
    from lists of who has an element, so sets without a common element cost nothing. The lists are made for so many sets at
    a time that they stay small beside the sets.
    """
    whole = np.array([s[1].sum() for s in sets])
    first = block == block.min()
    left, right = np.flatnonzero(first), np.flatnonzero(first if first.all() else ~first)
    parent: dict = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    found = []
    elements = np.cumsum([len(sets[b][0]) for b in right])
    for tile in np.split(right, np.flatnonzero(np.diff((elements - 1) // TILE)) + 1):
        listed = np.concatenate([sets[b][0] for b in tile])
        order = np.argsort(listed, kind="stable")
        owner = np.repeat(np.arange(len(tile)), [len(sets[b][0]) for b in tile])[order]
        owner_weight = np.concatenate([sets[b][1] for b in tile])[order]
        unique, begins = np.unique(listed[order], return_index=True)
        begins = np.append(begins, len(listed))
        for a in left.tolist():
            at = np.minimum(np.searchsorted(unique, sets[a][0]), len(unique) - 1)
            mine = np.flatnonzero(unique[at] == sets[a][0])
            at = at[mine]
            sizes = begins[at + 1] - begins[at]
            where = np.repeat(begins[at], sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            shared = np.bincount(owner[where], weights=np.minimum(owner_weight[where], np.repeat(sets[a][1][mine], sizes)), minlength=len(tile))
            near = shared >= threshold * (whole[tile] + whole[a] - shared) - 1e-9
            if first.all():
                near &= tile < a
            for b in tile[near].tolist():
                x, y = find(roots[a]), find(roots[b])
                if x != y:
                    parent[x] = y
                    found.append((a, b))
    return found


def _name(words: Words, k: int, text: bytes) -> int:
    """64 bits that name a text: its words in order, or all its bytes if it has no word."""
    begin, end = words.begins[k], words.begins[k + 1]
    data = words.hashes[begin:end].tobytes() if end > begin else b"text" + text
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True)


def rarest(hashes: np.ndarray, weights: np.ndarray, counts: np.ndarray, threshold: float) -> np.ndarray:
    """The rarest elements of a set, so many that the rest weighs less than threshold of the whole.

    Two sets of that similarity share one of them: the first element they share, in order of rarity, is among those of both,
    as what follows in either set is too light for all that they must share.
    """
    order = np.lexsort((hashes, counts[(hashes >> np.uint64(64 - DF_BITS)).astype(np.int64)]))
    rest = weights.sum() - np.cumsum(weights[order])
    return hashes[order[: int(np.searchsorted(-rest, -threshold * weights.sum() * (1 - 1e-9), "right")) + 1]]


@contextmanager
def bounded(spark: SparkSession) -> Iterator[None]:
    """Within it, Python gets texts in batches of BATCHES, and jobs leave no shuffle files; what holds when a job starts counts."""
    options = BATCHES | CLEANUP
    before = {k: spark.conf.get(k, None) for k in options}
    for k, v in options.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def inverse_frequencies(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Weights of shingles by hash bucket, from the frequencies over all documents, and these frequencies.

    The table has 2**DF_BITS entries at any input size. A bucket's weight is the log of documents per document with one of
    its shingles, as a share of the log at RARE and at most 1: for shingles of less than RARE of all documents, or of
    fewer than FEW, it is 1.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, n = np.zeros(1 << DF_BITS, dtype=np.int64), 0
        for batch in batches:
            n += batch.num_rows
            for _, texts in chunks(batch.column("text"), PART):
                hashes, begins = shingles(hash_words(texts))
                buckets = (hashes >> np.uint64(64 - DF_BITS)).astype(np.int64)
                seen = np.unique(np.repeat(np.arange(len(texts)), np.diff(begins)) << DF_BITS | buckets)
                sums += np.bincount(seen & ((1 << DF_BITS) - 1), minlength=1 << DF_BITS)
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(np.append(at, -1), pa.int32()), "n": pa.array(np.append(sums[at], n), pa.int64())})

    table = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    bucket, n = table.column("bucket").to_numpy(), table.column("n").to_numpy()
    total = max(int(n[bucket < 0].sum()), 1)
    found = np.ones(1 << DF_BITS)
    found[bucket[bucket >= 0]] = np.maximum(n[bucket >= 0], 1)
    return np.where(found < FEW, 1.0, np.clip(np.log(total / found) / np.log(1 / RARE), 0.05, 1.0)), found


def deal_blocks(members: DataFrame) -> DataFrame:
    """(family, low, high, block, node, root) of the nodes of each family: what is compared, block with block.

    members are (family, node, root), and size, their number of shingles, if it is known. Nodes outside the main class have
    blocks of their own, and so have those inside it, of about BLOCK_NODES and at most about BLOCK_SHINGLES. An inner node goes to the outer blocks only, so a family of copies and a few strays has each copy
    about once.
    """
    size = F.sum("size") if "size" in members.columns else F.lit(0)
    sizes = members.groupBy("family", "root").agg(F.count("*").alias("n"), size.alias("size")).groupBy("family").agg(
        F.max_by(F.struct("root", "size"), F.struct("n", "root")).alias("main"), F.max("n").alias("inner"), F.sum("n").alias("n"), F.sum("size").alias("size"), F.count("*").alias("classes")
    )
    blocks = lambda n, size: F.greatest(F.ceil(n / BLOCK_NODES), F.ceil(size / BLOCK_SHINGLES)).cast("int")
    inside = blocks(F.col("inner"), F.col("main.size")).alias("inside")
    outside = blocks(F.col("n") - F.col("inner"), F.col("size") - F.col("main.size")).alias("outside")
    sizes = sizes.where("classes > 1").select("family", F.col("main.root").alias("main"), inside, outside)
    placed = members.join(sizes, "family").withColumn("outer", F.col("root") != F.col("main"))
    block = F.when(F.col("outer"), F.pmod(F.xxhash64("node"), F.col("outside"))).otherwise(F.col("outside") + F.pmod(F.xxhash64("node"), F.col("inside")))
    others = F.sequence(F.lit(0), F.when(F.col("outer"), F.col("outside") + F.col("inside")).otherwise(F.col("outside")) - 1)
    dealt = placed.select("family", "node", "root", block.cast("int").alias("block"), F.explode(others).alias("other"))
    return dealt.select("family", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "node", "root")


def texts_of(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows of wanted (doc, version, ...) with their text. wanted is read twice, so it is best a table of its own.

    Rows of texts are marked by bits of a hash, and only those that may be asked for are shuffled, once for each (doc,
    version). More rows than bits make the marks useless, not wrong.
    """
    place = F.pmod(F.xxhash64("doc", "version"), F.lit(1 << MARK_BITS))
    bit = F.expr("shiftleft(1L, cast(place & 63 AS int))")
    marks = wanted.select(place.alias("place")).groupBy(F.shiftright("place", 6).alias("word")).agg(F.bit_or(bit).alias("marked"))
    placed = texts.withColumn("place", place).withColumn("word", F.shiftright("place", 6))
    asked = placed.join(F.broadcast(marks), "word").where(F.col("marked").bitwiseAND(bit) != 0)
    return wanted.join(asked.groupBy("doc", "version").agg(F.first("text").alias("text")), ["doc", "version"])


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """A row for every row of docs: doc_id, version, node, class_id, class_size and keeps.

    Documents whose shingles have a weighted Jaccard similarity of threshold or more are linked, and classes are what links
    connect; class_id is the smallest doc_id of a class, class_size its number of rows, keeps tells the one row to keep of
    each class (of several rows with the same doc_id and text all have it). Shingles are five words; letters of A-Z are
    compared without case, and what lies between words doesn't count. Texts of fewer words are one shingle. Texts without
    a word are copies only of equal texts; null texts are alone. A null doc_id comes after all others.

    Texts with the same words are collapsed before anything is compared. Each bucket's members are compared with three of
    them, its hubs: each with the one it meets in most buckets first, then with the others that this leaves in another class.
    Texts are not kept: they are read again where they are asked for, and go to the task of a hub or a block. Where that leaves a bucket in several classes, its members form families by their rarest shingles, of which texts
    of the threshold's similarity share at least one. A family's members outside its main class are compared with all of
    it in blocks of bounded size, inside a task; only links that connect classes come out. So no link is lost there, and
    members of one class are not compared.
    """
    named = docs.select(order_id(F.col("doc_id")).alias("doc"), F.col("text").cast("string").alias("text"))
    named = named.withColumn("version", F.coalesce(text_key(F.col("text")), F.lit(0)))
    with bounded(docs.sparkSession):
        sketches, roots = _classes(named.where(F.col("text").isNotNull()), threshold)
    classed = sketches.select("doc", "version", "node").join(roots, "node", "left").select("doc", "version", "node", F.coalesce("root", "node").alias("root"))
    classes = classed.groupBy("root").agg(F.min("doc").alias("class_doc"), F.count("*").alias("class_size"))
    firsts = classed.groupBy("root").agg(F.min(F.struct("doc", "version")).alias("kept"))
    told = classed.join(classes.join(firsts, "root"), "root")
    told = told.select("doc", "version", "node", "class_doc", "class_size", (F.struct("doc", "version") == F.col("kept")).alias("keeps"))
    alone = named.where(F.col("text").isNull()).select("doc", "version", F.lit(None).cast("long").alias("node"), F.col("doc").alias("class_doc"), F.lit(1).cast("long").alias("class_size"), F.lit(True).alias("keeps"))
    shown = lambda c: F.when(F.col(c) != LAST_ID, F.col(c))
    return told.union(alone).select(shown("doc").alias("doc_id"), "doc", "version", "node", shown("class_doc").alias("class_id"), "class_size", "keeps")

def _classes(texts: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """(doc, version, node, ...) of the rows of texts, and (node, root) of the nodes that are linked with others."""
    spark = texts.sparkSession
    weights, frequencies = inverse_frequencies(texts)
    idf, counts = spark.sparkContext.broadcast(weights), spark.sparkContext.broadcast(frequencies)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, part in chunks(batch.column("text"), PART):
                words = hash_words(part)
                hashes, begins = shingles(words)
                names, keys, sizes = [], [], np.diff(begins)
                for k, text in enumerate(part):
                    names.append(_name(words, k, text))
                    own = hashes[begins[k] : begins[k + 1]]
                    keys.append(band_keys(sample_weighted(*_weighted(own, idf.value))) if len(own) else np.zeros(0, np.int64))
                offsets = np.cumsum([0] + [len(x) for x in keys])
                rows = batch.slice(at, len(part))
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc"), rows.column("version"), pa.array(names, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(keys), pa.int64())), pa.array(sizes, pa.int64())],
                    names=["doc", "version", "node", "bands", "size"],
                )

    sketches = cut(texts.select("doc", "version", "text").mapInArrow(sketch, "doc long, version long, node long, bands array<long>, size long"))
    distinct = cut(sketches.groupBy("node").agg(F.min(F.struct("doc", "version")).alias("named"), F.first("bands").alias("bands"), F.first("size").alias("size")))
    members = distinct.select("node", F.posexplode("bands").alias("band", "key"))
    hubs = [F.min("node"), F.max("node"), F.min_by("node", F.xxhash64("node"))]
    buckets = members.groupBy("band", "key").agg(F.array(*hubs).alias("hubs"), F.count("*").alias("n")).where("n > 1")
    shared = cut(members.join(buckets.drop("n"), ["band", "key"]))
    to_hubs = shared.select(F.col("node").alias("a"), F.explode("hubs").alias("b")).where("a <> b")
    pairs = cut(to_hubs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).groupBy("u", "v").agg(F.count("*").alias("n")))
    # A node's text is that of one of its rows. A doc_id alone would not tell it, as rows may share one or have none.
    rows = distinct.select("node", "named.*", "size")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, last = None, None, None
        for batch in batches:
            linked = []
            hub, part, node = (batch.column(c).to_pylist() for c in ("hub", "slice", "node"))
            for begin, texts in chunks(batch.column("text"), PART):
                hashes, begins = shingles(hash_words(texts))
                for k, row in enumerate(range(begin, begin + len(texts))):
                    own = _weighted(hashes[begins[k] : begins[k + 1]], idf.value)
                    if at != (hub[row], part[row]):
                        at, held, last = (hub[row], part[row]), own, hub[row]
                    elif node[row] != last:
                        last = node[row]
                        if weighted_jaccard(held, own) >= threshold:
                            linked.append((last, hub[row]))
            yield pa.RecordBatch.from_pydict({"u": pa.array([a for a, _ in linked], pa.int64()), "v": pa.array([b for _, b in linked], pa.int64())})

    def head(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, part in chunks(batch.column("text"), PART):
                hashes, begins = shingles(hash_words(part))
                keys = [rarest(*_weighted(hashes[begins[k] : begins[k + 1]], idf.value), counts.value, threshold) for k in range(len(part))]
                place = pa.array(at + np.repeat(np.arange(len(part)), [len(x) for x in keys]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(keys).view(np.int64), pa.int64()), batch.column("node").take(place)], names=["head", "node"]
                )

    def compare_blocks(table: pa.Table) -> pa.Table:
        """Links between members of two blocks in different classes; those that connect what is connected already are left out."""
        sets = []
        for column in table.column("text").chunks:
            for _, part in chunks(column, PART):
                hashes, begins = shingles(hash_words(part))
                sets += [_weighted(hashes[begins[k] : begins[k + 1]], idf.value) for k in range(len(part))]
        linked = links_between(sets, table.column("block").to_numpy(), table.column("root").to_pylist(), threshold)
        nodes = table.column("node").to_pylist()
        return pa.table({"u": pa.array([nodes[a] for a, _ in linked], pa.int64()), "v": pa.array([nodes[b] for _, b in linked], pa.int64())})

    def verified(candidates: DataFrame) -> DataFrame:
        """The links among candidate pairs (u, v). The members of a hub v come behind it, in slices that each have its text."""
        sizes = candidates.groupBy("v").agg(F.ceil(F.count("*") / SLICE).cast("int").alias("slices"))
        members = candidates.join(sizes, "v").select(F.col("u").alias("node"), F.col("v").alias("hub"), F.pmod(F.xxhash64("u"), F.col("slices")).cast("int").alias("slice"))
        hubs = sizes.select(F.col("v").alias("node"), F.col("v").alias("hub"), F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"))
        wanted = cut(members.union(hubs).join(rows.drop("size"), "node"))
        dealt = texts_of(texts, wanted).select("hub", "slice", "node", "text").repartition("hub", "slice")
        return dealt.sortWithinPartitions("hub", "slice", F.col("node") != F.col("hub"), "node").mapInArrow(verify, "u long, v long")

    nearest = cut(pairs.groupBy("u").agg(F.max_by("v", F.struct("n", "v")).alias("v")))
    links = cut(verified(nearest))
    roots = cut(components(links))
    own_root = lambda c: roots.select(F.col("node").alias(c), F.col("root").alias(f"root_{c}"))
    others = pairs.join(nearest.withColumnRenamed("v", "near"), "u").where("v <> near").join(own_root("u"), "u", "left").join(own_root("v"), "v", "left")
    others = cut(others.where(F.coalesce("root_u", "u") != F.coalesce("root_v", "v")).select("u", "v"))
    if not others.isEmpty():
        links = cut(links.union(verified(others)))
        roots = cut(components(links))
    placed = cut(shared.select("band", "key", "node").join(roots, "node", "left").select("band", "key", "node", F.coalesce("root", "node").alias("root")))
    mixed = placed.groupBy("band", "key").agg(F.min("root").alias("least"), F.max("root").alias("most")).where("least < most")
    unsure = cut(placed.join(mixed.select("band", "key"), ["band", "key"], "left_semi").select("node", "root").distinct().join(rows, "node"))
    heads = cut(texts_of(texts, unsure).select("node", "text").mapInArrow(head, "head long, node long"))
    least = heads.groupBy("head").agg(F.min("node").alias("v"))
    families = components(heads.select("head", F.col("node").alias("u")).join(least, "head").select("u", "v").where("u <> v").distinct())
    dealt = deal_blocks(families.withColumnRenamed("root", "family").join(unsure, "node"))
    dealt = texts_of(texts, cut(dealt.join(rows.drop("size"), "node")))
    more = cut(dealt.groupBy("family", "low", "high").applyInArrow(compare_blocks, "u long, v long"))
    if not more.isEmpty():
        roots = cut(components(links.union(more)))
    return sketches, roots


def drop_near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row of docs for each class of near duplicates, with all its columns: that of the smallest doc_id."""
    kept = near_duplicates(docs.select("doc_id", "text"), threshold).where("keeps").select("doc", "version").distinct()
    version = F.coalesce(text_key(F.col("text").cast("string")), F.lit(0))
    marked = docs.select(F.struct("*").alias("whole"), order_id(F.col("doc_id")).alias("doc"), version.alias("version"))
    one = F.row_number().over(Window.partitionBy("doc", "version").orderBy(F.lit(0)))
    return marked.join(kept, ["doc", "version"], "left_semi").withColumn("number", one).where("number = 1").select("whole.*")
