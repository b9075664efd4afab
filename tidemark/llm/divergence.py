"""How far the sources of a language differ in the words they use: run-length columns of counts, intersected pair by pair."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import cut, whole_text

#: What stands between terms.
BETWEEN = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
#: Documents of a language that a term is kept from.
LEAST_DOCS = 30
#: Added to every count, and what shares are multiplied by (a third power, so that three steps of long division give it).
SMOOTH, STEP = 5, 1000
SCALE = STEP**3
TOP_TERMS = 50
#: Bytes of text that are split at a time; rows of counts that a task holds before it passes them on; terms of a block.
PIECE, HELD, BLOCK = 1 << 22, 1 << 20, 1 << 16

_between = np.array([b <= 0x40 or 0x5B <= b <= 0x60 or 0x7B <= b <= 0x7F for b in range(256)])

COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])
COLUMNS = "lang string, n_terms long, columns array<struct<source:string,starts:array<int>,counts:array<long>>>"


def pieces(text: bytes, most: int) -> Iterator[bytes]:
    """A long text in parts of about most bytes, cut between terms."""
    at = 0
    while at < len(text):
        end = at + most
        while end < len(text):
            # The first byte from here on that is in no term.
            stops = np.flatnonzero(_between[np.frombuffer(text, np.uint8, count=min(most, len(text) - end), offset=end)])
            if len(stops):
                end += int(stops[0])
                break
            end += most
        yield text[at:end]
        at = end


def split_terms(texts: pa.Array) -> pa.Table:
    """(row, term, n) of the terms of each text."""
    parts = pc.split_pattern_regex(pc.ascii_lower(texts), BETWEEN)
    row = np.repeat(np.arange(len(texts)), pc.list_value_length(parts).to_numpy(zero_copy_only=False))
    found = pa.table({"row": row, "term": parts.flatten()})
    found = found.filter(pc.not_equal(found["term"], ""))
    return found.group_by(["row", "term"]).aggregate([([], "count_all")]).rename_columns(["row", "term", "n"])


def _term_counts(texts: pa.Array, groups: np.ndarray, most: int) -> Iterator[pa.Table]:
    """(group, term, n, docs) of a batch, in parts of about most bytes of text; a longer text is one document all the same."""
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
    begin = 0
    while begin < len(texts):
        if sizes[begin] > most:
            parts = [split_terms(pa.array([p.decode()])) for p in pieces(texts[begin].as_py().encode(), most)]
            table = pa.concat_tables(parts).group_by("term").aggregate([("n", "sum")]).rename_columns(["term", "n"])
            yield table.append_column("group", pa.array(np.full(len(table), groups[begin]))).append_column("docs", pa.array(np.ones(len(table), np.int64)))
            begin += 1
            continue
        fits = int(np.searchsorted(np.cumsum(np.where(sizes[begin:] > most, most + 1, sizes[begin:])), most, "right"))
        end = begin + max(fits, 1)
        table = split_terms(texts.slice(begin, end - begin))
        table = table.append_column("group", pa.array(groups[begin:end][table["row"].to_numpy()]))
        yield table.group_by(["group", "term"]).aggregate([("n", "sum"), ([], "count_all")]).rename_columns(["group", "term", "n", "docs"])
        begin = end


def _added(tables: list[pa.Table]) -> pa.Table:
    whole = pa.concat_tables([t.select(["group", "term", "n", "docs"]) for t in tables])
    return whole.group_by(["group", "term"]).aggregate([("n", "sum"), ("docs", "sum")]).rename_columns(["group", "term", "n", "docs"])


def count_terms(docs: DataFrame, piece: int = PIECE, held: int = HELD) -> DataFrame:
    """(lang, source, term, n, docs): occurrences of a term and the documents that hold it, added up within tasks only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: list[tuple[str, str]] = []
        known: dict[tuple[str, str], int] = {}
        waiting: list[pa.Table] = []
        rows = 0

        def shown(table: pa.Table) -> Iterator[pa.RecordBatch]:
            group = table["group"].to_numpy()
            columns = [pa.array([n[k] for n in names], pa.string()).take(pa.array(group)) for k in (0, 1)]
            yield from pa.table([*columns, table["term"], table["n"], table["docs"]], schema=COUNTS).to_batches(max_chunksize=1 << 16)

        for batch in batches:
            keys = zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist())
            groups = np.empty(batch.num_rows, np.int64)
            for k, key in enumerate(keys):
                if key not in known:
                    known[key] = len(names)
                    names.append(key)
                groups[k] = known[key]
            for table in _term_counts(batch.column("text"), groups, piece):
                waiting.append(table)
                rows += len(table)
                if rows > held:
                    waiting = [_added(waiting)]
                    rows = len(waiting[0])
                    if rows > held // 2:
                        yield from shown(waiting.pop())
                        rows = 0
        if waiting:
            yield from shown(_added(waiting))

    return docs.mapInArrow(run, "lang string, source string, term string, n long, docs long")


def share(count, total, n_terms):
    """1 + floor(SCALE * (count + SMOOTH) / (total + SMOOTH * n_terms)) in whole numbers, for arrays and for columns.

    Long division in steps of STEP keeps every number in 64 bits for up to nine thousand million million occurrences.
    """
    over = total + n_terms * SMOOTH
    rest, found = count + SMOOTH, None
    for _ in range(3):
        rest = rest * STEP
        digit = F.call_function("div", rest, over) if isinstance(rest, Column) else rest // over
        rest, found = rest % over, digit if found is None else found * STEP + digit
    return found + 1


def run_columns(kept: DataFrame, block: int = BLOCK) -> DataFrame:
    """(lang, n_terms, columns): blocks of terms, and for each source that has any of them its counts as runs.

    Terms are dealt out by their totals and put in the order of their counts by source, so that equal counts stand together. Any
    number of tasks share the terms of a language. What bounds are sampled from is two numbers, not the counts.
    """
    alike = F.xxhash64(F.to_json("counts"))
    ordered = kept.select("lang", "total", "counts").repartitionByRange("lang", "total", alike).select("lang", "counts").sortWithinPartitions("lang", "counts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def runs(lang: str, vectors: list[list[dict]]) -> pa.RecordBatch:
            cells: dict[str, list[tuple[int, int]]] = {}
            for k, vector in enumerate(vectors):
                for cell in vector:
                    cells.setdefault(cell["source"], []).append((k, cell["n"]))
            columns = []
            for source, found in cells.items():
                dense = np.zeros(len(vectors), np.int64)
                at, n = np.array(found, np.int64).T
                dense[at] = n
                starts = np.flatnonzero(np.concatenate(([True], np.diff(dense) != 0)))
                columns.append({"source": source, "starts": starts.tolist(), "counts": dense[starts].tolist()})
            kind = pa.list_(pa.struct([("source", pa.string()), ("starts", pa.list_(pa.int32())), ("counts", pa.list_(pa.int64()))]))
            return pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([len(vectors)], pa.int64()), pa.array([columns], kind)], names=["lang", "n_terms", "columns"])

        at, vectors = None, []
        for batch in batches:
            for lang, vector in zip(batch.column("lang").to_pylist(), batch.column("counts").to_pylist()):
                if vectors and (lang != at or len(vectors) == block):
                    yield runs(at, vectors)
                    vectors = []
                at = lang
                vectors.append(vector)
        if vectors:
            yield runs(at, vectors)

    return ordered.mapInArrow(run, COLUMNS)


def run_distance(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], n: int) -> int:
    """The sum of |a - b| over n places of two columns of runs, each run of both taken once."""
    bounds = np.union1d(a[0], b[0])
    lengths = np.diff(np.append(bounds, n))
    left = a[1][np.searchsorted(a[0], bounds, "right") - 1]
    right = b[1][np.searchsorted(b[0], bounds, "right") - 1]
    return int(np.abs(left - right) @ lengths)


def _pair_sums(blocks: DataFrame) -> DataFrame:
    """(lang, left, right, value) of all pairs of sources of a block's language, left before right."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                n, found = row["n_terms"] or 0, {c["source"]: c for c in row["columns"] or []}
                columns = {}
                for source in row["sources"]:
                    name, total = source["source"], source["n"]
                    column = found.get(name, {"starts": [0], "counts": [0]})
                    counts = np.array(column["counts"], np.int64)
                    columns[name] = (np.array(column["starts"], np.int64), share(counts, total, row["v"]) if n else counts)
                pairs = list(combinations(sorted(columns), 2))
                for k in range(0, len(pairs), 1 << 16):
                    part = pairs[k : k + (1 << 16)]
                    values = [run_distance(columns[a], columns[b], n) if n else 0 for a, b in part]
                    yield pa.RecordBatch.from_pydict({
                        "lang": [row["lang"]] * len(part), "left": [a for a, _ in part], "right": [b for _, b in part], "value": values,
                    })

    return blocks.mapInArrow(run, "lang string, left string, right string, value long")


def audit_sources(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP_TERMS, piece: int = PIECE, held: int = HELD, block: int = BLOCK) -> DataFrame:
    """(lang, source, part, item, value, rank): how far a source's use of words is from each other source and from its language.

    Terms are runs of letters A-Z, lower-cased, and of all characters beyond ASCII. A language keeps the terms that
    least_docs of its rows hold. A source's share of a kept term is 1 + floor(10^9 (count + 5) / (N + 5 V)), N its occurrences
    of kept terms and V their number. Part "pair" has the sum of |difference of shares| over all kept terms for every other
    source of the language, 0 if none is kept; part "term" has the top terms that a source has above its language's share.
    Ranks begin at 1 for each source and part, by falling value, then by item in the order of UTF-8.

    Null text, lang and source are empty strings; each row counts as one document, repeated ones and those without an id
    too. A source without terms is compared all the same; a language of one source has no pairs. Texts of any length are
    split whole, in pieces. Only text, lang and source are read, so other columns may have any name. An empty table gives none.

    Counts are added up in tasks before they are shuffled by (lang, term), so a hot source is at most one row per task and
    term. The sources of a language stand in one row, as their pairs are the result anyway.
    """
    read = docs.select(*[whole_text(F.col(c)).alias(c) for c in ("lang", "source", "text")])
    counted = count_terms(read, piece, held).repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    by_term = counted.groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.sum("n").alias("total"), F.sort_array(F.collect_list(F.struct("source", "n"))).alias("counts")
    )
    kept = cut(by_term.where(F.col("docs") >= least_docs).drop("docs"))
    cells = kept.select("lang", "term", "total", F.inline("counts"))
    per_lang = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("total").alias("lang_n"))
    per_source = cells.groupBy("lang", "source").agg(F.sum("n").alias("source_n"))
    groups = read.select("lang", "source").distinct().join(per_source, ["lang", "source"], "left").join(per_lang, "lang", "left")
    groups = cut(groups.na.fill(0, ["source_n", "v", "lang_n"]))

    langs = groups.groupBy("lang").agg(F.first("v").alias("v"), F.collect_list(F.struct("source", F.col("source_n").alias("n"))).alias("sources"))
    sums = _pair_sums(langs.join(run_columns(kept, block), "lang", "left")).groupBy("lang", "left", "right").agg(F.sum("value").alias("value"))
    both = F.array(F.struct(F.col("left").alias("source"), F.col("right").alias("item")), F.struct(F.col("right").alias("source"), F.col("left").alias("item")))
    pairs = sums.select("lang", F.inline(both), F.lit("pair").alias("part"), "value")

    p, q = share(F.col("n"), F.col("source_n"), F.col("v")), share(F.col("total"), F.col("lang_n"), F.col("v"))
    terms = cells.where("n > 0").join(groups, ["lang", "source"]).select("lang", "source", F.col("term").alias("item"), F.lit("term").alias("part"), (p - q).alias("value"))

    def ranked(df: DataFrame) -> DataFrame:
        order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
        return df.withColumn("rank", F.row_number().over(order))

    best = ranked(terms.where("value > 0")).where(F.col("rank") <= top)
    return ranked(pairs).unionByName(best).select("lang", "source", "part", "item", "value", "rank")
