"""Stored text index: TF-IDF search that reads only the postings of the queries' terms, and of those the ones that can matter.

A term's postings lie in blocks of documents with like weights, each with its largest weight; blocks are in term order, a page
of them is a row, and the table is partitioned by term. Best blocks give every query a score that its k-th document has at
least. A block whose largest weight, with all that the query's other terms can add, stays below it cannot hold a document of
the result and is skipped.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.operators.nearest import BROADCAST_BYTES
from pagemill.operators.retrieval import ENTRY_BYTES, HEAD_TERMS, RESULT, known_terms, query_weights
from pagemill.operators.terms import idf_weight, term_counts
from pagemill.operators.topk import DIGITS, query_chunks, rank_scores
from pagemill.session import broadcast_if_small, new_table_path, written

#: Between tasks numbers travel as the bytes of their array: ``_packed`` and ``_unpacked``.
RUNS = "run long, documents long, n_terms long, postings long, doc_ids binary, rows binary, tfs binary, words binary, lengths binary, frequencies binary"
TERMS_DEALT = "shard long, run long, places binary, words binary, lengths binary, frequencies binary"
NUMBERED = "run long, places binary, numbers binary, frequencies binary, term array<string>, term_no array<long>, df array<long>"
DEALT = "shard long, term_no binary, piece binary, doc_id binary, weight binary"
PICKED = "term_no binary, top binary, sizes binary, doc_ids binary, weights binary"
FOUND = "shard long, term_no binary, doc_id binary, weight binary"
PAGES = "term_no array<long>, top array<double>, ends array<int>, doc_ids array<long>, weights array<double>, part int"
RUN_COLUMNS = [column.split()[0] for column in RUNS.split(", ")]
#: Bounds give way by this much, beyond the rounding of scores.
SLACK = 1e-5
#: Postings that a task holds at a time: of the index that is built, and of a search.
SHARD_ENTRIES, SCORE_ENTRIES = 1 << 20, 1 << 18
#: Documents are counted in runs of so many tokens, and terms numbered in shards of so many entries (a term of a run).
RUN_TOKENS, TERM_ENTRIES = 1 << 19, 1 << 20
#: Postings of a page, and terms of a row that lists them.
PAGE_ENTRIES = 1 << 16
#: Rows are long, so their number says nothing of a row group's size.
LONG_ROWS = {"parquet.block.size": 16 << 20, "parquet.page.size.row.check.min": 1, "parquet.enable.dictionary": "false"}


@dataclass(frozen=True)
class TextIndex:
    """``terms`` (term, term_no, df, idf) and ``blocks`` in pages, partitioned by ``part``, below ``path``."""

    path: str
    parts: int

    def terms(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema("term string, term_no long, df long, idf double").parquet(f"{self.path}/terms")

    def pages(self, spark: SparkSession, parts: list[int]) -> DataFrame:
        """Pages of some parts of the terms; other parts' files are not opened."""
        return spark.read.schema(PAGES).parquet(f"{self.path}/blocks").filter(F.col("part").isin(parts))

    def blocks(self, spark: SparkSession, parts: list[int]) -> DataFrame:
        """The same, a row per block: ``term_no, top, doc_ids, weights, part``."""

        def block(no: Column) -> Column:
            start = F.coalesce(F.get("ends", no - 1), F.lit(0))
            lists = [F.slice(c, start + 1, F.get("ends", no) - start).alias(c) for c in ("doc_ids", "weights")]
            return F.struct(F.get("term_no", no).alias("term_no"), F.get("top", no).alias("top"), *lists)

        blocks = F.transform(F.sequence(F.lit(0), F.size("ends") - 1), block)
        return self.pages(spark, parts).select(F.inline(blocks), "part")

    def tops(self, spark: SparkSession, parts: list[int]) -> DataFrame:
        """``term_no, top``: largest weights of terms, one or several a term."""
        return self.pages(spark, parts).select("term_no", "top").mapInArrow(_page_tops, "term_no long, top double")


def _part(term_no: Column, parts: int) -> Column:
    return F.pmod(term_no, F.lit(parts)).cast("int")


def build_text_index(
    documents: DataFrame, key: str, tokens: Column, path: str | None = None, parts: int = 64, block_rows: int = 1024,
    head_terms: int = HEAD_TERMS, run_tokens: int = RUN_TOKENS,
) -> TextIndex:
    """Write the index of all documents with a key that is not null.

    A weight is ``tf * idf`` over the length of the document's vector. A block holds weights of one quarter of a power of
    two, so that its largest says much about all of them, and about ``block_rows`` documents, however common the term.

    Documents are counted in runs of about ``run_tokens``. Only a run's distinct terms travel, once a run; they come back with
    their number and frequency, and the run makes its postings. No term is looked up document by document, so frequent ones
    need no table of their own and ``head_terms`` has no effect.
    """
    spark = documents.sparkSession
    path = path or new_table_path(spark, "text-index")
    present = documents.filter(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("doc_id"), F.coalesce(tokens, F.array().cast("array<string>")).alias("tokens"))
    runs = _written_long(present.mapInArrow(_runs(run_tokens), RUNS), RUNS, "text-runs")
    n_documents, entries, postings = runs.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("documents", "n_terms", "postings")]).first()
    shards = max(spark.sparkContext.defaultParallelism, -(-entries // TERM_ENTRIES))
    dealt = runs.select("run", "words", "lengths", "frequencies").mapInArrow(_by_hash(shards), TERMS_DEALT)
    numbered = _written_long(dealt.groupBy("shard").applyInArrow(_numbered, NUMBERED), NUMBERED, "term-numbers")
    terms = numbered.filter("run is null").select(F.inline(F.arrays_zip("term", "term_no", "df")))
    terms.withColumn("idf", idf_weight(n_documents, F.col("df"))).write.parquet(f"{path}/terms")

    shards = max(1, -(-postings // (parts * SHARD_ENTRIES)))  # of a part
    found = numbered.filter("run is not null").select("run", "places", "numbers", "frequencies")
    both = runs.select("run", "doc_ids", "rows", "tfs", F.col("frequencies").alias("sizes")).groupBy("run").cogroup(found.groupBy("run"))
    dealt = both.applyInArrow(_by_term(n_documents, parts, shards, block_rows), DEALT)
    dealt.groupBy("shard").applyInArrow(_blocks(parts), PAGES).write.partitionBy("part").options(**LONG_ROWS).parquet(f"{path}/blocks")
    return TextIndex(path, parts)


def _written_long(table: DataFrame, schema: str, label: str) -> DataFrame:
    path = new_table_path(table.sparkSession, label)
    table.write.options(**LONG_ROWS).parquet(path)
    return table.sparkSession.read.schema(schema).parquet(path)


def _runs(run_tokens: int):
    """Documents and their tokens, counted in runs: the run's distinct terms, and for each the rows of its documents."""

    def run(number: int, batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        doc_ids, lists = (pa.concat_arrays([batch.column(c) for batch in batches]) for c in (0, 1))
        row = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy())
        encoded = lists.flatten().dictionary_encode()
        n = max(len(lists), 1)
        pair, tf = np.unique(encoded.indices.to_numpy() * np.int64(n) + row, return_counts=True)
        place, rows = np.divmod(pair, n)
        words, ends = _words(encoded.dictionary)
        counts = [pa.array([x]) for x in (number, len(lists), len(encoded.dictionary), len(rows))]
        numbers = [x.astype(np.int32) for x in (rows, tf, np.bincount(place, minlength=len(encoded.dictionary)))]
        whole = [_packed(x, [0, len(x)]) for x in (doc_ids.to_numpy(), *numbers[:2], words, np.diff(ends), numbers[2])]
        return pa.RecordBatch.from_arrays(counts + whole, RUN_COLUMNS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, tokens, number = [], 0, TaskContext.get().partitionId() << 32
        for batch in batches:
            held.append(batch)
            tokens += len(batch.column(1).flatten())
            if tokens >= run_tokens:
                yield run(number, held)
                held, tokens, number = [], 0, number + 1
        if held:
            yield run(number, held)

    return count


def _packed(values: np.ndarray, edges: np.ndarray | list[int]) -> pa.Array:
    """The bytes of every run of values between two edges."""
    offsets = np.asarray(edges, dtype=np.int64) * values.itemsize
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))])


def _unpacked(column: pa.Array | pa.ChunkedArray, kind: type) -> np.ndarray:
    """The values of all rows, one after the other."""
    chunks = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    parts = []
    for chunk in (c for c in chunks if len(c)):
        _, offsets, values = chunk.buffers()
        edges = np.frombuffer(offsets, np.int32)[chunk.offset:chunk.offset + len(chunk) + 1]
        if edges[-1] > edges[0]:
            parts.append(np.frombuffer(values, np.uint8)[edges[0]:edges[-1]].view(kind))
    return np.concatenate(parts) if parts else np.zeros(0, dtype=kind)


def _words(terms: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of strings, and where the first starts and each ends."""
    if not len(terms):
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int32)
    _, offsets, values = terms.buffers()
    ends = np.frombuffer(offsets, np.int32)[terms.offset:terms.offset + len(terms) + 1]
    return (np.frombuffer(values, np.uint8) if values else np.zeros(0, dtype=np.uint8))[ends[0]:ends[-1]], ends - ends[0]


def _strings(words: np.ndarray, lengths: np.ndarray) -> pa.Array:
    ends = np.append(0, np.cumsum(lengths)).astype(np.int32)
    return pa.Array.from_buffers(pa.string(), len(lengths), [None, pa.py_buffer(ends), pa.py_buffer(words)])


def _by_hash(shards: int):
    """Deal the terms of runs."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for no, run in enumerate(batch.column("run").to_pylist()):
                row = batch.slice(no, 1)
                lengths, frequencies = (_unpacked(row.column(c), np.int32) for c in ("lengths", "frequencies"))
                terms = _strings(_unpacked(row.column("words"), np.uint8), lengths)
                shard = pd.util.hash_array(terms.to_numpy(zero_copy_only=False), categorize=False) % np.uint64(shards)
                order, edges, numbers = _order(shard)
                words, ends = _words(terms.take(pa.array(order)))
                columns = [numbers, pa.array(np.full(len(numbers), run)), _packed(order.astype(np.int32), edges), _packed(words, ends[edges])]
                columns += [_packed(x[order], edges) for x in (lengths, frequencies)]
                yield pa.RecordBatch.from_arrays(columns, ["shard", "run", "places", "words", "lengths", "frequencies"])

    return deal


def _numbered(key: tuple, shard: pa.Table) -> pa.Table:
    """Numbers and document frequencies of a shard's terms, for every run, and without a run the list of the terms."""
    lengths, frequencies = (_unpacked(shard.column(c), np.int32) for c in ("lengths", "frequencies"))
    encoded = _strings(_unpacked(shard.column("words"), np.uint8), lengths).dictionary_encode()
    index, terms = encoded.indices.to_numpy().astype(np.int64), encoded.dictionary
    df = np.bincount(index, frequencies, len(terms)).astype(np.int64)
    first = key[0].as_py() << 32
    edges = np.append(0, np.cumsum(pc.binary_length(shard.column("places")).to_numpy() // 4))
    runs = [shard.column("run"), shard.column("places"), _packed(first + index, edges), _packed(df[index], edges)]
    cuts = pa.array(np.append(np.arange(0, len(terms), PAGE_ENTRIES), len(terms)), pa.int32())
    lists = [pa.ListArray.from_arrays(cuts, x) for x in (terms, first + np.arange(len(terms)), df)]
    names = ["run", "places", "numbers", "frequencies", "term", "term_no", "df"]
    kinds = [pa.int64(), pa.binary(), pa.binary(), pa.binary(), *(x.type for x in lists)]
    runs += [pa.nulls(shard.num_rows, kind) for kind in kinds[4:]]
    listed = [*(pa.nulls(len(cuts) - 1, kind) for kind in kinds[:4]), *lists]
    schema = pa.schema(list(zip(names, kinds, strict=True)))
    return pa.concat_tables([pa.table(columns, names).cast(schema) for columns in (runs, listed)])


def _order(shard: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """The order by shard, where each shard starts and the last ends, and the shards' numbers."""
    if len(shard) and shard.max() < 1 << 16:
        shard = shard.astype(np.uint16)  # sorted by digits
    order = np.argsort(shard, kind="stable")
    shard = shard[order]
    first = np.flatnonzero(np.append(True, shard[1:] != shard[:-1])) if len(shard) else order
    return order, np.append(first, len(order)), pa.array(shard[first].astype(np.int64))


def _dealt(shard: np.ndarray, columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    """A row per shard, with the bytes of its values of every column."""
    order, edges, numbers = _order(shard)
    return pa.RecordBatch.from_arrays([numbers, *(_packed(x[order], edges) for x in columns.values())], ["shard", *columns])


def _mixed(x: np.ndarray) -> np.ndarray:
    """Whole numbers as evenly spread hashes, not negative."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(1)).astype(np.int64)


def _by_term(n_documents: int, parts: int, shards: int, block_rows: int):
    """Deal the postings of a run: a shard has whole terms, and of a common one whole pieces."""

    def deal(run: pa.Table, found: pa.Table) -> pa.Table:
        doc = _unpacked(run.column("doc_ids"), np.int64)
        row, tf, sizes = (_unpacked(run.column(c), np.int32) for c in ("rows", "tfs", "sizes"))
        places = _unpacked(found.column("places"), np.int32)
        numbers, frequencies = np.zeros((2, len(places)), dtype=np.int64)
        for values, column in ((numbers, "numbers"), (frequencies, "frequencies")):
            values[places] = _unpacked(found.column(column), np.int64)
        weight = tf * np.repeat(np.log((n_documents + 1) / (frequencies + 1)), sizes)
        length = np.sqrt(np.bincount(row, weight * weight, len(doc)))
        here = weight > 0
        row, weight = row[here], weight[here]
        weight, doc = weight / length[row], doc[row]
        term, pieces = (np.repeat(x, sizes)[here] for x in (numbers, -(-frequencies // block_rows)))
        piece = np.where(pieces > 1, _mixed(doc) % np.maximum(pieces, 1), 0)
        shard = term % parts
        if shards > 1:
            shard += parts * (_mixed(term + _mixed(piece)) % shards)
        return pa.Table.from_batches([_dealt(shard, {"term_no": term, "piece": piece, "doc_id": doc, "weight": weight})])

    return deal


def _blocks(parts: int):
    """The blocks of a shard, in term order and in pages."""

    def build(shard: pa.Table) -> pa.Table:
        term, piece, doc = (_unpacked(shard.column(c), np.int64) for c in ("term_no", "piece", "doc_id"))
        weight = _unpacked(shard.column("weight"), np.float64)
        level = np.floor(np.log2(weight) * 4).astype(np.int64)
        order = np.lexsort((piece - level * (piece.max() + 1), term))
        term, piece, level, weight = term[order], piece[order], level[order], weight[order]
        new = (np.diff(term) != 0) | (np.diff(level) != 0) | (np.diff(piece) != 0)
        first = np.flatnonzero(np.append(True, new))
        page = first // PAGE_ENTRIES
        heads = np.flatnonzero(np.append(True, page[1:] != page[:-1]))  # of pages, among the blocks
        starts = first[heads]
        last = np.append(first[1:], len(term))
        ends = (last - np.repeat(starts, np.diff(np.append(heads, len(first))))).astype(np.int32)
        of_blocks, of_postings = (pa.array(np.append(x, n), pa.int32()) for x, n in ((heads, len(first)), (starts, len(term))))
        lists = [pa.ListArray.from_arrays(of_blocks, x) for x in (term[first], np.maximum.reduceat(weight, first), ends)]
        lists += [pa.ListArray.from_arrays(of_postings, x) for x in (doc[order], weight)]
        part = np.full(len(heads), term[0] % parts, dtype=np.int32)
        return pa.table([*lists, pa.array(part)], ["term_no", "top", "ends", "doc_ids", "weights", "part"])

    return build


def _page_tops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The largest weight of every term that follows another."""
    for batch in batches:
        term, top = (batch.column(c).flatten().to_numpy() for c in ("term_no", "top"))
        first = np.flatnonzero(np.append(True, term[1:] != term[:-1])) if len(term) else np.zeros(0, dtype=np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(term[first]), pa.array(np.maximum.reduceat(top, first) if len(term) else top)], ["term_no", "top"])


def asked_terms(index: TextIndex, queries: DataFrame, key: str, tokens: Column) -> DataFrame:
    """``query_id, term_no, weight, df, top, rest``: unit weights of known terms, and what the query's other terms add at most."""
    spark = queries.sparkSession
    counts = term_counts(queries.select(F.col(key).cast("long").alias("query_id"), tokens.alias("tokens")), "query_id", F.col("tokens"))
    terms = written(known_terms(counts, index.terms(spark)), "known-terms")
    tops = index.tops(spark, _asked_parts(index, terms)).join(broadcast_if_small(terms.select("term_no", "df")), "term_no")
    tops = tops.groupBy("term_no", "df").agg(F.max("top").alias("top"))
    weights = written(query_weights(counts, terms.select("term", "idf", "term_no")).join(tops, "term_no"), "query-weights")
    most = weights.groupBy("query_id").agg(F.sum(F.col("weight") * F.col("top")).alias("most"))
    return weights.join(most, "query_id").select("query_id", "term_no", "weight", "df", "top", (F.col("most") - F.col("weight") * F.col("top")).alias("rest"))


def _asked_parts(index: TextIndex, asked: DataFrame) -> list[int]:
    return [row[0] for row in asked.select(_part(F.col("term_no"), index.parts)).distinct().collect()]  # at most the index's parts


def _picked(index: TextIndex, asked: DataFrame) -> DataFrame:
    """The blocks of the terms that are asked for, taken from their pages."""
    numbers = np.sort(asked.select("term_no").distinct().toPandas()["term_no"].to_numpy(dtype=np.int64))  # at most one per entry of the chunk
    shared = asked.sparkSession.sparkContext.broadcast(numbers)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = shared.value
        for batch in batches:
            term, top, ends, doc, weight = (batch.column(c).flatten().to_numpy() for c in ("term_no", "top", "ends", "doc_ids", "weights"))
            if not len(terms) or not len(term):
                continue
            pages = np.cumsum(pc.list_value_length(batch.column("ends")).to_numpy())[:-1]
            sizes = np.diff(ends, prepend=0).astype(np.int32)
            sizes[pages] = ends[pages]  # the first block of every page
            here = terms[np.minimum(np.searchsorted(terms, term), len(terms) - 1)] == term
            postings = np.repeat(here, sizes)
            columns = {"term_no": term[here], "top": top[here], "sizes": sizes[here], "doc_ids": doc[postings], "weights": weight[postings]}
            if here.any():
                yield pa.RecordBatch.from_arrays([_packed(x, [0, len(x)]) for x in columns.values()], list(columns))

    return index.pages(asked.sparkSession, _asked_parts(index, asked)).drop("part").mapInArrow(pick, PICKED)


def _scores(index: TextIndex, asked: DataFrame, least_top: DataFrame, k: int, picked: DataFrame | None = None) -> DataFrame:
    """``query_id, doc_id, score``: every query's best, over the blocks of a term whose largest weight reaches ``least_top(term_no,
    least_top)``.

    Postings are dealt by their document and scored against all queries where they meet, so pairs are never rows.
    """
    context = asked.sparkSession.sparkContext
    entries = asked.select("term_no", "df").distinct().agg(F.sum("df")).first()[0] or 0
    shards = max(1, -(-entries // SCORE_ENTRIES))
    needed = least_top.toPandas().sort_values("term_no")  # at most a row per entry of the chunk
    least = context.broadcast([needed[c].to_numpy() for c in ("term_no", "least_top")])
    pages = _picked(index, asked) if picked is None else picked
    dealt = pages.mapInArrow(_by_document(least, shards), FOUND)
    table = asked.select("query_id", "term_no", "weight").toPandas().sort_values("query_id")
    shared = context.broadcast([table[c].to_numpy() for c in ("query_id", "term_no", "weight")])
    return dealt.groupBy("shard").applyInArrow(_best(shared, k), RESULT)


def _by_document(needed, shards: int):
    """Deal the postings of the blocks that are needed."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, least = needed.value
        for batch in batches:
            term, doc = (_unpacked(batch.column(c), np.int64) for c in ("term_no", "doc_ids"))
            top, weight = (_unpacked(batch.column(c), np.float64) for c in ("top", "weights"))
            sizes = _unpacked(batch.column("sizes"), np.int32)
            if not len(terms) or not len(term):
                continue
            place = np.minimum(np.searchsorted(terms, term), len(terms) - 1)
            here = (terms[place] == term) & (top >= least[place])
            postings = np.repeat(here, sizes)
            doc, weight = doc[postings], weight[postings]
            yield _dealt(_mixed(doc) % shards, {"term_no": np.repeat(term[here], sizes[here]), "doc_id": doc, "weight": weight})

    return deal


def _best(shared, k: int):
    """The best documents of a shard for every query."""

    def score(shard: pa.Table) -> pa.Table:
        query, asked, weight = shared.value
        term, doc = (_unpacked(shard.column(c), np.int64) for c in ("term_no", "doc_id"))
        w = _unpacked(shard.column("weight"), np.float64)
        order = np.argsort(term, kind="stable")
        docs, at = np.unique(doc[order], return_inverse=True)
        term, w = term[order], w[order]
        first, last = np.searchsorted(term, asked, "left"), np.searchsorted(term, asked, "right")
        ids, starts = np.unique(query, return_index=True)
        found = []
        for own, a, b in zip(ids, starts, np.append(starts[1:], len(query)), strict=True):
            met = [e for e in range(a, b) if last[e] > first[e]]
            if not met:
                continue
            places = np.concatenate([at[first[e]:last[e]] for e in met])
            products = np.concatenate([w[first[e]:last[e]] * weight[e] for e in met])
            scores = np.round(np.bincount(places, products, len(docs)), DIGITS)
            best = np.flatnonzero(scores > 0)
            if len(best) > k:
                best = best[scores[best] >= np.partition(scores[best], -k)[-k]]
            best = best[np.lexsort((docs[best], -scores[best]))][:k]
            found.append((np.full(len(best), own), docs[best], scores[best]))
        columns = map(np.concatenate, zip(*found, strict=True)) if found else ([], [], [])
        return pa.table([pa.array(x, kind) for x, kind in zip(columns, (pa.int64(), pa.int64(), pa.float64()), strict=True)], ["query_id", "doc_id", "score"])

    return score


def _bounded(index: TextIndex, asked: DataFrame, k: int, picked: DataFrame | None = None) -> DataFrame:
    """``asked`` with ``least``, a score that every query's ``k``-th document has at least: from the best blocks of its terms."""
    best = _scores(index, asked, asked.select("term_no", (F.col("top") / 1.5).alias("least_top")).distinct(), k, picked)  # partial sums: no score is smaller
    ranked = rank_scores(best, "query_id", "doc_id", "score", k)
    least = written(ranked.filter(F.col("rank") == k).select("query_id", F.col("score").alias("least")), "least-scores")
    return asked.join(least, "query_id", "left").withColumn("least", F.coalesce("least", F.lit(0.0)))


def open_blocks(index: TextIndex, asked: DataFrame, k: int) -> DataFrame:
    """The blocks that each query must read: those of its terms that its k-th score so far does not rule out."""
    blocks = index.blocks(asked.sparkSession, _asked_parts(index, asked)).withColumnRenamed("top", "block_top")
    met = blocks.join(broadcast_if_small(_bounded(index, asked, k)), "term_no")
    return met.filter(F.col("weight") * F.col("block_top") + F.col("rest") + SLACK >= F.col("least"))


def search_text(index: TextIndex, queries: DataFrame, key: str, tokens: Column, k: int, batch_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``query_id, doc_id, score, rank``: the ``k`` documents nearest to every query, as ``retrieval.tfidf_search`` finds them.

    Query terms that the index does not know carry no weight; queries without any have no rows, and keys should differ.
    Queries are taken in chunks of at most ``batch_bytes``; a chunk goes over the pages once, keeps the blocks of its terms, and
    reads of these what one of its queries must read.
    """
    asked = written(asked_terms(index, queries, key, tokens), "asked-terms")
    least_top = F.min((F.col("least") - F.col("rest") - SLACK) / F.col("weight")).alias("least_top")
    found = []
    for chunk in query_chunks(asked, "query_id", asked.count() * ENTRY_BYTES, batch_bytes):
        picked = _written_long(_picked(index, chunk), PICKED, "picked-blocks")
        needed = written(_bounded(index, chunk, k, picked).groupBy("term_no").agg(least_top), "least-tops")
        found.append(_scores(index, chunk, needed, k, picked))
    return rank_scores(reduce(DataFrame.union, found), "query_id", "doc_id", "score", k)
