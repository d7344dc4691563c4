"""Review-text operators: cleaning, per-item term counts, TF-IDF, keywords,
item-item similarity, vocabularies, integer encoding, word and document vectors.

Nothing concatenates an item's reviews into one string: TF-IDF counts tokens
per (item, token) with partial aggregation, so an item with a third of all
reviews costs one pre-aggregated row per map task.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean_text, vectorizer_tokens, wordpunct_tokens
from . import blocked
from .common import BROADCAST_MAX_BYTES, join_small, materialize, top_n_per_group
from .ids import ordered_index

PAD, UNK = "", "[UNK]"
# Tokens whose vectors a task holds at once.
TOKENS_AT_ONCE = 1 << 15


def item_term_counts(reviews: DataFrame, item: str = "business_id", text: str = "text") -> DataFrame:
    """``(item, token, tf)``: word/punctuation tokens of the lower-cased cleaned text."""
    toks = reviews.select(item, F.explode(wordpunct_tokens(clean_text(text), lower=True)).alias("token"))
    return toks.groupBy(item, "token").agg(F.count(F.lit(1)).alias("tf"))


def item_documents(reviews: DataFrame, item: str = "business_id", order: str = "review_id",
                   text: str = "text") -> DataFrame:
    """``(item, part, text)``: the cleaned reviews of each item in ``order``; the
    item document is the blank-joined sequence of its parts.

    Part numbers come from a distributed ordered index (range partitioned),
    so a hot item is spread over many tasks instead of one group."""
    rows = reviews.select(item, order, clean_text(text).alias("text"))
    pos = ordered_index(rows, [F.col(item).asc(), F.col(order).asc()], "_g")
    start = pos.groupBy(item).agg(F.min("_g").alias("_s"))
    return pos.join(start, item).select(item, (F.col("_g") - F.col("_s")).alias("part"), "text")


def tfidf(tf: DataFrame, doc: str = "business_id", n_docs: int | None = None,
          max_features: int | None = 100, max_df: float | int = 0.8,
          min_df: float | int = 1) -> tuple[DataFrame, DataFrame]:
    """Smoothed TF-IDF with L2-normalised rows.

    Document-frequency limits first (float = fraction of documents, int =
    count), then the ``max_features`` terms with the largest corpus count
    (ties: token asc).  ``idf = ln((1 + n) / (1 + df)) + 1``.
    Returns ``(weights (doc, token, tfidf), vocab (token, df, ctf, idf))``;
    the vocabulary is bounded by ``max_features``.
    """
    if n_docs is None:
        n_docs = tf.select(doc).distinct().count()
    hi = max_df * n_docs if isinstance(max_df, float) else max_df
    lo = min_df * n_docs if isinstance(min_df, float) else min_df
    st = tf.groupBy("token").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("ctf"))
    st = st.where((F.col("df") >= F.lit(lo)) & (F.col("df") <= F.lit(hi)))
    if max_features is not None:
        st = st.orderBy(F.col("ctf").desc(), F.col("token").asc()).limit(max_features)
    vocab = st.withColumn("idf", F.log((F.lit(1.0) + n_docs) / (F.lit(1.0) + F.col("df"))) + 1.0)
    w = tf.join(F.broadcast(vocab.select("token", "idf")) if max_features else vocab.select("token", "idf"),
                "token").select(doc, "token", (F.col("tf") * F.col("idf")).alias("w"))
    norm = w.groupBy(doc).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("_n"))
    out = w.join(norm, doc).select(
        doc, "token", F.when(F.col("_n") > 0, F.col("w") / F.col("_n")).otherwise(0.0).alias("tfidf"))
    return out, vocab


def top_keywords(weights: DataFrame, doc: str = "business_id", k: int = 10) -> DataFrame:
    return top_n_per_group(weights, doc, [F.round("tfidf", 6).desc(), F.col("token").asc()], k)


def _item_item(weights: DataFrame, vocab: DataFrame, doc: str, k: int | None,
               exclude_self: bool) -> DataFrame:
    """Blocked cosine scoring of every item against every item; each item keeps
    its k best partners (all of them when ``k`` is None)."""
    weights = materialize(weights.select(doc, "token", "tfidf"), "tfidf")
    feats = ordered_index(vocab.select("token"), [F.col("token").asc()], "fidx")
    n_feat = feats.count()
    docs = ordered_index(weights.select(doc).distinct(), [F.col(doc).asc()], "did")
    n_docs = docs.count()
    wv = weights.join(feats, "token").join(docs, doc)
    q = (wv.groupBy("did").agg(F.collect_list("fidx").alias("fidx"), F.collect_list("tfidf").alias("w")))
    queries = docs.join(q, "did", "left").select(
        F.col("did").alias("qid"), F.coalesce("fidx", F.array().cast("array<bigint>")).alias("fidx"),
        F.coalesce("w", F.array().cast("array<double>")).alias("w"))
    queries = materialize(queries, "item-vectors")
    targets = queries.select(F.array("qid").alias("cids"), "fidx", "w")
    if k:
        queries = queries.join(blocked.term_floor(queries, targets, k), "qid")
    top = blocked.blocked_top_n(queries, targets, n_feat, k or max(n_docs, 1), exclude_self=exclude_self, by="direction")
    a, b = docs.alias("a"), docs.alias("b")
    return (top.join(a, F.col("qid") == F.col("a.did")).join(b, F.col("cid") == F.col("b.did"))
            .select(F.col(f"a.{doc}").alias(doc), "rank", F.col(f"b.{doc}").alias(f"other_{doc}"),
                    F.col("score").alias("sim")))


def item_item_topk(weights: DataFrame, vocab: DataFrame, doc: str = "business_id",
                   k: int = 5) -> DataFrame:
    """``(doc, rank, other, sim)``: the k most cosine-similar other items.

    Rows are L2-normalised, so cosine = dot product; scored with the blocked
    top-n operator (no item x item join, no per-term pair emission), which skips blocks of
    items whose terms can't bring them into an item's list."""
    return _item_item(weights, vocab, doc, k, exclude_self=True)


def item_item_cosine(weights: DataFrame, vocab: DataFrame, doc: str = "business_id") -> DataFrame:
    """``(doc, other, sim)``: the full item x item cosine matrix (diagonal and
    zero similarities included).  The output is quadratic in the item count by
    definition; it is computed by the same blocked scorer as
    :func:`item_item_topk` (no pair join), which is the form to use at scale."""
    m = _item_item(weights, vocab, doc, None, exclude_self=False)
    return m.select(doc, f"other_{doc}", "sim")


# ------------------------------------------------------------------ text encoder

def text_vocab(texts: DataFrame, text: str = "text", max_tokens: int = 5000) -> DataFrame:
    """``(token, idx, n)``: index 0 padding ``''``, 1 unknown ``[UNK]``, then the
    ``max_tokens - 2`` most frequent tokens (ties: token asc) from 2.

    The ranking is a top-k (per-partition then merged), bounded by
    ``max_tokens``; the final numbering runs over that bounded set."""
    toks = texts.select(F.explode(vectorizer_tokens(text)).alias("token"))
    cnt = toks.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    top = cnt.orderBy(F.col("n").desc(), F.col("token").asc()).limit(max_tokens - 2)
    from pyspark.sql import Window
    ranked = top.select("token", (F.row_number().over(
        Window.orderBy(F.col("n").desc(), F.col("token").asc())) + 1).cast("long").alias("idx"), "n")
    spark = texts.sparkSession
    specials = spark.createDataFrame([(PAD, 0, 0), (UNK, 1, 0)], "token string, idx long, n long")
    return specials.unionByName(ranked)


def encode_texts(texts: DataFrame, vocab: DataFrame, key: str = "review_id",
                 text: str = "text") -> DataFrame:
    """``(key, pos, idx)``: token positions mapped through the vocabulary
    (unknown -> 1).  The vocabulary is bounded, so it is broadcast."""
    toks = texts.select(key, F.posexplode(vectorizer_tokens(text)).alias("pos", "token"))
    v = F.broadcast(vocab.where("idx >= 2").select("token", "idx"))
    return toks.join(v, "token", "left").select(
        key, F.col("pos").cast("long").alias("pos"), F.coalesce("idx", F.lit(1)).cast("long").alias("idx"))


def decode_texts(encoded: DataFrame, vocab: DataFrame, key: str = "review_id") -> DataFrame:
    """``(key, text)``: blank-joined vocabulary tokens in position order.  The
    group is one text's own tokens."""
    j = encoded.join(F.broadcast(vocab.select("idx", "token")), "idx")
    return j.groupBy(key).agg(F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct("pos", "token"))), lambda s: s["token"]), " ").alias("text"))


def word_vectors(vocab: DataFrame, vectors: DataFrame, vec_key: str = "vec_id",
                 vec_col: str = "embedding") -> DataFrame:
    """``(token, idx, vec)``: the rank-r vocabulary token (``idx = r + 2``) takes
    vector row r; padding and unknown get zero vectors; tokens past the
    vector table have no row (they encode as unknown)."""
    real = vocab.where("idx >= 2").join(vectors, F.col("idx") - 2 == F.col(vec_key)).select(
        "token", "idx", F.col(vec_col).alias("vec"))
    dim = vectors.select(F.size(vec_col).alias("d")).agg(F.max("d")).first()[0] or 0
    zeros = F.array_repeat(F.lit(0.0).cast("float"), dim)
    specials = vocab.where("idx < 2").select("token", "idx", zeros.alias("vec"))
    return specials.unionByName(real)


def doc_means(texts: DataFrame, wv: DataFrame, key: str = "review_id",
              text: str = "text") -> DataFrame:
    """``(key, vec)``: the mean word vector of each text with a known token (unknown tokens
    count as zero vectors; a vector's null components as 0; shorter vectors end in zeros, and
    a text's mean is as long as the longest vector of its tokens).

    A text is in one row, so its sum is made where the text lies (:func:`_text_sums`) and only one
    row of sums a text is shuffled, to bring together texts that share a key.  Vectors beyond the
    broadcast bound meet the tokens, counted per (text, token), in a shuffle join."""
    one = wv.where("idx >= 2 AND size(vec) > 0").select("token", F.col("vec").alias("_v"))
    vecs = materialize(one, "token-vectors")
    n, dim = vecs.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("_v")), F.lit(0))).first()
    names = [f"_s{j}" for j in range(dim)]
    if n * 8 * (8 + dim) <= BROADCAST_MAX_BYTES:
        parts = _text_sums(texts.select(F.col(key).alias("_key"), vectorizer_tokens(text).alias("_tokens")), vecs, dim)
    else:
        toks = texts.select(F.col(key).alias("_key"), F.explode(vectorizer_tokens(text)).alias("token"))
        per = toks.groupBy("_key", "token").agg(F.count(F.lit(1)).cast("double").alias("_n"))
        known = vecs.select("token", F.size("_v").alias("_d"), *[F.coalesce(F.get("_v", F.lit(j)).cast("double"), F.lit(0.0)).alias(f"_s{j}")
                                                                  for j in range(dim)])
        parts = per.join(known, "token", "left").select(
            "_key", "_n", "_d", *[(F.coalesce(c, F.lit(0.0)) * F.col("_n")).alias(c) for c in names])
    sums = parts.groupBy("_key").agg(F.sum("_n").alias("_n"), F.max("_d").alias("_d"), *[F.sum(c).alias(c) for c in names])
    mean = F.slice(F.array(*[F.col(c) / F.col("_n") for c in names]).cast("array<double>"), F.lit(1), F.col("_d"))
    return sums.where("_d IS NOT NULL").select(F.col("_key").alias(key), mean.alias("vec"))


def _text_sums(rows: DataFrame, vecs: DataFrame, dim: int) -> DataFrame:
    """``_key, _n, _d, _s0 ..`` for each row of ``(_key, _tokens)`` with a token: how many tokens, the longest vector
    among them (null: none known) and the sum of their vectors.  A token with several vectors counts
    once for each.  ``vecs`` ``(token, _v)`` goes to every task."""
    spark = rows.sparkSession
    found: dict[str, int] = {}
    table, times, longest = [], [], []
    for token, v in vecs.collect():
        at = found.setdefault(token, len(table))
        if at == len(table):
            table.append(np.zeros(dim))
            times.append(0)
            longest.append(0)
        table[at][:len(v)] += [0.0 if x is None else float(x) for x in v]
        times[at] += 1
        longest[at] = max(longest[at], len(v))
    sent = spark.sparkContext.broadcast((list(found), np.array(table).reshape(len(table), dim), np.array(times, dtype=np.int64),
                                         np.array(longest, dtype=np.int64)))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, table, times, longest = sent.value
        known = pa.array(names, pa.string())
        for batch in batches:
            tokens = batch.column("_tokens")
            sizes = tokens.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            ids = pc.fill_null(pc.index_in(tokens.flatten().cast(pa.string()), value_set=known), -1).to_numpy(zero_copy_only=False)
            owner = np.repeat(np.arange(batch.num_rows), sizes)
            hit = np.flatnonzero(ids >= 0)
            ids, at = ids[hit], owner[hit]
            n = sizes.copy()
            np.add.at(n, at, times[ids] - 1)
            d = np.zeros(batch.num_rows, np.int64)
            np.maximum.at(d, at, longest[ids])
            sums = np.zeros((batch.num_rows, dim))
            for a in range(0, len(ids), TOKENS_AT_ONCE):  # rows of one text lie together
                own = at[a:a + TOKENS_AT_ONCE]
                first = np.flatnonzero(np.diff(own, prepend=-1))
                sums[own[first]] += np.add.reduceat(table[ids[a:a + TOKENS_AT_ONCE]], first)
            keep = np.flatnonzero(sizes)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_key").take(pa.array(keep)), pa.array(n[keep].astype(np.float64)), pa.array(d[keep].astype(np.int32), mask=d[keep] == 0),
                 *[pa.array(np.ascontiguousarray(sums[keep, j])) for j in range(dim)]], ["_key", "_n", "_d", *[f"_s{j}" for j in range(dim)]])

    kind = rows.schema["_key"].dataType.simpleString()
    return rows.mapInArrow(run, ", ".join([f"_key {kind}", "_n double", "_d int", *[f"_s{j} double" for j in range(dim)]]))


def doc_vectors(texts: DataFrame, wv: DataFrame, key: str = "review_id",
                text: str = "text") -> DataFrame:
    """``(key, dim, value)``: ``doc_means`` in long form."""
    return doc_means(texts, wv, key, text).select(key, F.posexplode("vec").alias("dim", "value")).select(
        key, F.col("dim").cast("long").alias("dim"), "value")


def token_col(c: str | Column) -> Column:
    return vectorizer_tokens(c)
