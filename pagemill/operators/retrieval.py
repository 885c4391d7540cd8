"""Text retrieval: cosine of TF-IDF vectors over the whole vocabulary, top-k documents per query."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.operators.nearest import BROADCAST_BYTES
from pagemill.operators.terms import document_terms, term_counts, term_idf
from pagemill.operators.topk import BestScores, query_chunks, rank_scores, score_slices
from pagemill.session import broadcast_if_small, lookup_join, written

RESULT = "query_id long, doc_id long, score double"
ENTRY_BYTES = 64
# Terms known to every task: at most this many, none longer than this, so never more than some 15 MB.
HEAD_TERMS = 100_000
HEAD_TERM_BYTES = 64
# Documents meet their rare terms in groups of about so many.
GROUP_ROWS = 2000
# Products of weights that a task holds at a time.
PRODUCTS = 1 << 20


def tfidf_search(
    documents: DataFrame, doc_key: str, doc_tokens: Column,
    queries: DataFrame, query_key: str, query_tokens: Column, k: int,
    batch_bytes: int = BROADCAST_BYTES, head_terms: int = HEAD_TERMS,
) -> DataFrame:
    """``(query_id, doc_id, score, rank)``: the ``k`` documents nearest to every query.

    Query terms unknown to the documents carry no weight. Documents are tokenized once, into written counts. Queries are
    taken in chunks of at most ``batch_bytes``; for each, every document is scored inside its task, so only the best of
    each task travel. The ``head_terms`` most frequent terms meet their weights by broadcast, the others by ``lookup_join``.
    """
    documents = documents.select(F.col(doc_key).cast("long").alias("doc_id"), doc_tokens.alias("tokens"))
    queries = queries.select(F.col(query_key).cast("long").alias("query_id"), query_tokens.alias("tokens"))
    counted = written(document_terms(documents, "doc_id", F.col("tokens")), "document-terms")
    idf = written(term_idf(counted).withColumn("term_no", F.monotonically_increasing_id()), "idf")
    counts = term_counts(queries, "query_id", F.col("tokens"))
    weights = written(query_weights(counts, known_terms(counts, idf)), "query-weights")

    asked = broadcast_if_small(weights.select("term_no").distinct().withColumn("asked", F.lit(True)))
    lexicon = idf.join(asked, "term_no", "left").withColumn("term_no", F.when(F.col("asked"), F.col("term_no")))
    rows = document_weights(counted, lexicon, head_terms).filter(F.size("term_no") > 0).drop("df")
    size = weights.count() * ENTRY_BYTES
    if size > batch_bytes:
        rows = written(rows, "document-weights")
    partial = [_scan(rows, chunk, k) for chunk in query_chunks(weights, "query_id", size, batch_bytes)]
    return rank_scores(reduce(DataFrame.union, partial), "query_id", "doc_id", "score", k)


def known_terms(counts: DataFrame, terms: DataFrame) -> DataFrame:
    """The rows of ``terms`` that occur in ``counts``; the terms need no shuffle where ``counts`` has few."""
    return terms.join(broadcast_if_small(counts.select("term").distinct()), "term", "left_semi")


def query_weights(counts: DataFrame, idf: DataFrame) -> DataFrame:
    """``(query_id, term_no, weight)`` with unit length per query."""
    weighted = counts.join(idf, "term").select("query_id", "term_no", (F.col("tf") * F.col("idf")).alias("w"))
    lengths = weighted.groupBy("query_id").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("length"))
    unit = weighted.join(lengths, "query_id").filter("w > 0 and length > 0")
    return unit.select("query_id", "term_no", (F.col("w") / F.col("length")).alias("weight"))


def document_weights(counted: DataFrame, lexicon: DataFrame, head_terms: int) -> DataFrame:
    """``(doc_id, length, term_no, w, df)`` from ``document_terms`` and ``lexicon(term, df, idf, term_no)``.

    ``length`` is over all terms; the arrays ``term_no``, ``w`` and ``df`` have the terms with a ``term_no``. Frequent terms are
    looked up in a broadcast and folded into their document where it is; only the others are looked up by a join. Of these, a
    short one has at most a ``head_terms``-th of all entries, so only long ones may be common. Rows are told apart by a number,
    and meet their other terms in groups of about ``GROUP_ROWS``.
    """
    folded = _fold_head(counted, _head(lexicon, head_terms)).withColumn("row", F.monotonically_increasing_id())
    first = written(folded, "head")
    groups = max(1, -(-first.count() // GROUP_ROWS))
    group = F.pmod(F.xxhash64("row"), F.lit(groups)).alias("group")
    found = lookup_join(
        first.select("row", F.inline("rare")), lexicon.select("term", "df", "idf", "term_no"), "term",
        common=F.octet_length("term") > HEAD_TERM_BYTES,
    )
    rare = found.select(group, F.col("row").alias("of"), "term_no", (F.col("tf") * F.col("idf")).alias("w"), "df")
    both = first.drop("rare").withColumn("group", group).groupBy("group").cogroup(rare.groupBy("group"))
    return both.applyInArrow(_gathered, "doc_id long, length double, term_no array<long>, w array<double>, df array<long>")


def flat(lists: pa.ChunkedArray) -> np.ndarray:
    """The values of all lists, one after the other."""
    return pa.chunked_array([x.flatten() for x in lists.chunks], lists.type.value_type).to_numpy()


def _gathered(first: pa.Table, rare: pa.Table) -> pa.Table:
    """Rows of documents with their head terms, and the other terms of these rows: put together."""
    n, rows = first.num_rows, first.column("row").to_numpy()
    order = np.argsort(rows)
    place = order[np.searchsorted(rows[order], rare.column("of").to_numpy())]
    weight = rare.column("w").to_numpy()
    squares = first.column("squares").to_numpy() + np.bincount(place, weight * weight, n)
    term = pc.fill_null(rare.column("term_no"), -1).to_numpy()
    hit = term >= 0
    owner = np.concatenate([np.repeat(np.arange(n), pc.list_value_length(first.column("term_no")).to_numpy()), place[hit]])
    order = np.argsort(owner, kind="stable")
    edges = _offsets(owner[order], n)
    more = {"term_no": term, "w": weight, "df": rare.column("df").to_numpy()}
    hits = [pa.ListArray.from_arrays(edges, np.concatenate([flat(first.column(c)), x[hit]])[order]) for c, x in more.items()]
    return pa.table([first.column("doc_id"), pa.array(np.sqrt(squares)), *hits], ["doc_id", "length", *more])


def _head(lexicon: DataFrame, head_terms: int) -> pd.DataFrame:
    short = lexicon.filter(F.octet_length("term") <= HEAD_TERM_BYTES)
    return short.orderBy(F.desc("df"), "term").limit(head_terms).toPandas()


def _fold_head(counted: DataFrame, head: pd.DataFrame) -> DataFrame:
    """Per document: sum of squared weights and query hits of its head terms, and its other terms."""
    terms = pa.array(head["term"].astype(str), pa.string())
    idf, df = head["idf"].to_numpy(dtype=float), head["df"].to_numpy(dtype=np.int64)
    term_no = head["term_no"].fillna(-1).to_numpy(dtype=np.int64)
    shared = counted.sparkSession.sparkContext.broadcast((terms, idf, term_no, df))

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, weights, numbers, frequency = shared.value
        for batch in batches:
            lists, n = batch.column("terms"), batch.num_rows
            flat, tf = lists.flatten(), batch.column("tfs").flatten().to_numpy()
            row = np.repeat(np.arange(n), np.diff(lists.offsets.to_numpy()))
            place = pc.fill_null(pc.index_in(flat, value_set=known), -1).to_numpy()
            in_head = place >= 0
            owner, term = row[in_head], place[in_head]
            weight = tf[in_head] * weights[term]
            hit = numbers[term] >= 0
            edges = _offsets(owner[hit], n)
            rare = pa.StructArray.from_arrays([flat.filter(pa.array(~in_head)), pa.array(tf[~in_head])], ["term", "tf"])
            columns = [
                batch.column("doc_id"),
                pa.array(np.bincount(owner, weight * weight, n).astype(float)),
                *(pa.ListArray.from_arrays(edges, x) for x in (numbers[term[hit]], weight[hit], frequency[term[hit]])),
                pa.ListArray.from_arrays(_offsets(row[~in_head], n), rare),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "squares", "term_no", "w", "df", "rare"])

    schema = "doc_id long, squares double, term_no array<long>, w array<double>, df array<long>, rare array<struct<term:string,tf:long>>"
    return counted.mapInArrow(fold, schema)


def _offsets(owner: np.ndarray, rows: int) -> pa.Array:
    """List offsets for values whose (sorted) row numbers are ``owner``."""
    return pa.array(np.searchsorted(owner, np.arange(rows + 1)), pa.int32())


class QueryBlock:
    """Queries of one task as arrays: their weights in term order, and where each term starts."""

    def __init__(self, query_ids: np.ndarray, term_no: np.ndarray, weights: np.ndarray):
        order = np.lexsort((query_ids, term_no))
        self.ids, owner = np.unique(query_ids[order], return_inverse=True)
        self.terms, first = np.unique(term_no[order], return_index=True)
        self.owner, self.weights = owner, weights[order]
        self.starts = np.append(first, len(order))

    def score(self, best: BestScores, doc_ids, lengths, edges, term_no, weights) -> None:
        """Documents come as flat term numbers and weights, ``edges`` says where each of them ends."""
        if not len(self.terms):
            return
        place = np.minimum(np.searchsorted(self.terms, term_no), len(self.terms) - 1)
        asked = np.flatnonzero(self.terms[place] == term_no)
        place, weights = place[asked], weights[asked]
        count = self.starts[place + 1] - self.starts[place]
        first = np.searchsorted(asked, edges)  # of each document's asked terms
        products = np.append(0, np.cumsum(count))[first] // PRODUCTS
        lengths = np.where(lengths == 0, 1.0, lengths)
        for part in score_slices(len(doc_ids), len(self.ids)):
            scores = np.zeros((len(self.ids), part.stop - part.start))
            # Documents are taken in runs that together have about as many products as may be held at a time.
            cuts = part.start + 1 + np.flatnonzero(np.diff(products[part]))
            for start, stop in zip([part.start, *cuts], [*cuts, part.stop], strict=True):
                here = slice(first[start], first[stop])
                n = count[here]
                # Positions of the query entries of all terms of these documents, one term after the other.
                entry = np.repeat(self.starts[place[here]] - np.cumsum(n) + n, n) + np.arange(n.sum())
                column = np.repeat(np.repeat(np.arange(stop - start), np.diff(first[start:stop + 1])), n)
                cell = self.owner[entry] * (stop - start) + column
                sums = np.bincount(cell, self.weights[entry] * np.repeat(weights[here], n), len(self.ids) * (stop - start))
                scores[:, start - part.start:stop - part.start] = sums.reshape(len(self.ids), -1)
            scores /= lengths[part]
            scores[scores <= 0] = -np.inf
            best.add(scores, doc_ids[part])

    def result(self, best: BestScores) -> pa.RecordBatch:
        position, item, score = best.rows()
        columns = [pa.array(self.ids[position]), pa.array(item), pa.array(score)]
        return pa.RecordBatch.from_arrays(columns, ["query_id", "doc_id", "score"])


def _lists(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    return column.offsets.to_numpy(), column.values.to_numpy()


def _scan(rows: DataFrame, weights: DataFrame, k: int) -> DataFrame:
    """Every document is scored where it is, against all queries."""
    table = weights.toPandas()
    arrays = [table[c].to_numpy() for c in ("query_id", "term_no", "weight")]
    shared = rows.sparkSession.sparkContext.broadcast(arrays)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = QueryBlock(*shared.value)
        best = BestScores(len(queries.ids), k)
        for batch in batches:
            edges, term_no = _lists(batch.column("term_no"))
            _, found = _lists(batch.column("w"))
            doc_ids, lengths = batch.column("doc_id").to_numpy(), batch.column("length").to_numpy()
            queries.score(best, doc_ids, lengths, edges, term_no, found)
        yield queries.result(best)

    return rows.mapInArrow(score, RESULT)
