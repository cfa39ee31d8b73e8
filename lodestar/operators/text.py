"""Token-level text features as relational jobs.

Tokenising is a built-in expression (lower, regex split, drop empty tokens);
term and document frequencies are grouped counts, combined map-side before
any shuffle.  Joins of per-document rows with per-token weights split hot
tokens off into a bounded broadcast (``split_hot_join``), so a token found
in most documents never lands in one task.  Naive Bayes is trained and
applied as aggregations and joins over these tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.functions.fixed import WHITESPACE  # noqa: F401  (re-exported; Java's \s spelled out)
from lodestar.functions.hashing import with_hash_bucket
from lodestar.functions.scalar import java_split, split_words
from lodestar.operators.joins import bounded_broadcast, fits_rows, with_scalars
from lodestar.operators.partitioning import split_hot_join
from lodestar.session import materialize

MAX_CLASSES = 1000  # a class label has few values; more is taken for a mistake


def tokens(text: str | Column) -> Column:
    """Lower-case, split on whitespace runs, drop empty tokens (M5)."""
    col = F.col(text) if isinstance(text, str) else text
    return F.filter(F.split(F.lower(col), WHITESPACE), lambda t: t != F.lit(""))


def tokenizer_words(text: str | Column) -> Column:
    """Words as the reference's tokenizer has them: lower-cased, split at every single
    white-space character as Java does (empty words inside stay, trailing ones go)."""
    col = F.lower(F.col(text) if isinstance(text, str) else text)
    return java_split(col, WHITESPACE.removesuffix("+"))


def hashed_term_frequency(docs: DataFrame, doc_id: str, text: str, buckets: int, extra: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, token, tf) with ``token`` the hashed feature number of the words (M6 as ``HashingTF`` does).

    Words are counted first, so every distinct word of a document is hashed once."""
    words = docs.select(doc_id, *extra, F.explode(tokenizer_words(text)).alias("word"))
    counted = words.groupBy(doc_id, *extra, "word").agg(F.count(F.lit(1)).alias("tf"))
    return with_hash_bucket(counted, "word", "token", buckets).groupBy(doc_id, *extra, "token").agg(F.sum("tf").alias("tf"))


def word_count(df: DataFrame, text: str, sep: str = " ") -> DataFrame:
    """(word, n) over all lines, words split on ``sep`` (P16 + A2)."""
    words = df.select(F.explode(split_words(text, sep)).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def term_frequency(docs: DataFrame, doc_id: str, text: str, extra: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, token, tf): occurrences of each token in each document (M6, exact form).

    A document that is one row is counted inside that row and nothing of it is
    shuffled; only rows that share their id are counted by grouping."""
    ids = docs.groupBy(doc_id).agg(F.count(F.lit(1)).alias("_rows")).filter("_rows > 1").select(F.col(doc_id).alias("_id"))
    ids = materialize(ids, "shared-ids")
    if ids.isEmpty():
        return _counted_in_rows(docs, doc_id, text, extra)
    ids = bounded_broadcast(ids)
    same = F.col(doc_id).eqNullSafe(F.col("_id"))
    exploded = docs.join(ids, same, "left_semi").select(doc_id, *extra, F.explode(tokens(text)).alias("token"))
    grouped = exploded.groupBy(doc_id, *extra, "token").agg(F.count(F.lit(1)).alias("tf"))
    return _counted_in_rows(docs.join(ids, same, "left_anti"), doc_id, text, extra).unionByName(grouped)


def _counted_in_rows(docs: DataFrame, doc_id: str, text: str, extra: tuple[str, ...]) -> DataFrame:
    """(doc_id, [extra], token, tf) per row: its tokens sorted, the lengths of the runs of equal ones."""
    words = docs.select(doc_id, *extra, F.sort_array(tokens(text)).alias("_words"))
    begins = F.filter(F.transform("_words", lambda w, i: F.when((i == 0) | (w != F.get("_words", i - 1)), i)), lambda i: i.isNotNull())
    begins = words.select("*", begins.alias("_begins"))
    runs = F.transform("_begins", lambda i, k: F.struct(
        F.get("_words", i).alias("token"), (F.coalesce(F.get("_begins", k + 1), F.size("_words")) - i).cast("long").alias("tf")))
    return begins.select(doc_id, *extra, F.explode(runs).alias("_run")).select(doc_id, *extra, "_run.token", "_run.tf")


def document_frequency(tf: DataFrame) -> DataFrame:
    """(token, df): number of documents containing each token."""
    return tf.groupBy("token").agg(F.count(F.lit(1)).alias("df"))


def idf(tf: DataFrame, n_docs: DataFrame) -> DataFrame:
    """(token, idf) with Spark ML's formula ln((N + 1) / (df + 1)) (M7).

    ``n_docs`` is a one-row table with column ``n_docs``.
    """
    dfreq = with_scalars(document_frequency(tf), n_docs)
    return dfreq.select(
        "token", "df",
        F.log((F.col("n_docs") + F.lit(1.0)) / (F.col("df") + F.lit(1.0))).alias("idf"),
    )


def tf_idf(docs: DataFrame, doc_id: str, text: str, extra: tuple[str, ...] = (),
           store_stages: bool = True) -> DataFrame:
    """(doc_id, [extra], token, tf, idf, tf_idf) over a corpus.

    Term frequencies are computed once; with ``store_stages`` they and the
    vocabulary weights are written as tables to the shared folder
    (tokenising is the expensive step and its result feeds both the IDF
    aggregation and the join).  The join of frequencies with weights splits
    hot tokens off into a bounded broadcast (see ``split_hot_join``).
    """
    tf = term_frequency(docs, doc_id, text, extra)
    n_docs = docs.agg(F.count(F.lit(1)).alias("n_docs"))
    weights = idf(tf, n_docs).select("token", "df", "idf")
    total = None
    if store_stages:
        tf = materialize(tf, "tf")
        weights = materialize(idf(tf, n_docs).select("token", "df", "idf"), "idf")
        total = tf.count()
    joined = split_hot_join(tf, weights, "token", "df", total_rows=total)
    return joined.select(
        doc_id, *extra, "token", "tf", "idf", (F.col("tf") * F.col("idf")).alias("tf_idf")
    )


def naive_bayes_fit(docs: DataFrame, doc_id: str, text: str, label: str, smoothing: float = 1.0):
    """Train multinomial Naive Bayes on TF-IDF features by aggregation (M7, M9).

    With F(c, j) the summed TF-IDF value of token j over documents of class
    c, F(c) its total over tokens and V the vocabulary size, Spark ML's
    ``NaiveBayes`` stores log((F(c, j) + a) / (F(c) + a V)).  Because IDF
    depends on the token only, F(c, j) = idf(j) * occurrences of j in class
    c, so training needs one aggregation per (class, token) - occurrences and
    number of documents - and a join with the vocabulary-sized IDF table; the
    per-document rows are never joined.  That join has at most K rows per
    token, so no token can skew it.

    Returns ``(params, weights)``: ``params`` has a row per observed
    (class, token) with ``log_prob`` and the class's ``log_prob_unseen``
    (the value of every unobserved pair); ``weights`` is (token, df, idf).
    """
    tf = term_frequency(docs, doc_id, text, extra=(label,))
    return naive_bayes_fit_tf(tf, docs.agg(F.count(F.lit(1))).scalar(), label, smoothing)


def naive_bayes_fit_tf(tf: DataFrame, n_docs, label: str, smoothing: float = 1.0, n_features: int | None = None):
    """``naive_bayes_fit`` from term frequencies (doc, label, token, tf) and
    the number of training documents (an int or a scalar column).
    ``n_features``: size of a hashed feature space, which smoothing is over
    (default: the tokens of the training documents)."""
    pairs = materialize(
        tf.groupBy(label, "token").agg(F.sum("tf").alias("_occ"), F.count(F.lit(1)).alias("_nd")),
        "nb-pairs",
    )
    n_docs = F.lit(n_docs) if isinstance(n_docs, int) else n_docs
    weights = pairs.groupBy("token").agg(F.sum("_nd").alias("df")).select(
        "token", "df", F.log((n_docs + F.lit(1.0)) / (F.col("df") + F.lit(1.0))).alias("idf")
    )
    f = pairs.join(weights, "token").select(label, "token", (F.col("_occ") * F.col("idf")).alias("_f"))
    vocab_size = weights.agg(F.count(F.lit(1))).scalar() if n_features is None else F.lit(n_features)
    per_class = f.groupBy(label).agg(F.sum("_f").alias("_fc"))  # one row per class
    a = F.lit(float(smoothing))
    denom = F.col("_fc") + a * vocab_size
    # one row per class: broadcast, so the vocabulary is not shuffled by a column of few values
    params = f.join(bounded_broadcast(per_class, MAX_CLASSES), label).select(
        label, "token",
        F.log((F.col("_f") + a) / denom).alias("log_prob"),
        F.log(a / denom).alias("log_prob_unseen"),
    )
    return params, weights


def naive_bayes_priors(labelled: DataFrame, label: str, smoothing: float = 1.0) -> DataFrame:
    """(label, log_prior) = log((n_c + a) / (n + K a))."""
    counts = labelled.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    totals = counts.agg(F.sum("_n").alias("_total"), F.count(F.lit(1)).alias("_k"))
    a = F.lit(float(smoothing))
    return with_scalars(counts, totals).select(
        label, F.log((F.col("_n") + a) / (F.col("_total") + F.col("_k") * a)).alias("log_prior")
    )


def label_classes(train_docs: DataFrame, label: str) -> list:
    """The label values of the training documents, in order.  The model has a
    column per class, so a label of more than ``MAX_CLASSES`` values, which
    would be an id, is an error before any value reaches the driver."""
    values = train_docs.filter(F.col(label).isNotNull()).select(label).distinct()
    if not fits_rows(values, MAX_CLASSES):
        raise ValueError(f"{label!r} has more than {MAX_CLASSES} values; it does not look like a class label")
    return sorted(r[0] for r in values.collect())


def naive_bayes_model(train_tf: DataFrame, train_docs: DataFrame, label: str, classes: list | None = None,
                      smoothing: float = 1.0, n_features: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Train multinomial Naive Bayes on TF-IDF features as tables (M8, M9).

    ``train_tf`` is (doc, label, token, tf) of the training documents and
    ``train_docs`` one row per training document with its label (ids only,
    so counting it never touches the text).  Returns ``(vocab, priors)``:
    ``vocab`` has one row per training token with its ``idf`` and, per class
    k, ``delta_k`` = log P(token | k) minus the class's unseen-token
    log-probability; ``priors`` has per class its ``log_prior`` and
    ``log_prob_unseen``.  This is the model Spark ML's CountVectorizer ->
    IDF -> NaiveBayes pipeline fits, kept as tables instead of a driver-side
    matrix.  ``classes`` lists the label values (default: those of the training
    documents); one that the documents do not have is an error.
    """
    seen = label_classes(train_docs, label)
    if classes is None:
        classes = seen
    elif set(classes) != set(seen):
        raise ValueError(f"classes {sorted(classes)} differ from the labels of the training documents {seen}")
    n_docs = train_docs.agg(F.count(F.lit(1))).scalar()
    params, weights = naive_bayes_fit_tf(train_tf, n_docs, label, smoothing, n_features)
    deltas = (
        params.withColumn("_d", F.col("log_prob") - F.col("log_prob_unseen"))
        .groupBy("token").pivot(label, classes).agg(F.first("_d"))
    )
    vocab = weights.select("token", "idf").join(deltas, "token").select(
        "token", "idf", *[F.coalesce(F.col(f"`{c}`"), F.lit(0.0)).alias(f"delta_{i}") for i, c in enumerate(classes)]
    )
    unseen = params.groupBy(label).agg(F.first("log_prob_unseen").alias("log_prob_unseen"))
    priors = naive_bayes_priors(train_docs, label, smoothing).join(unseen, label)
    # The fitted model is a vocabulary-sized table, stored once so scoring
    # does not re-run training, and K prior rows.
    spark = train_docs.sparkSession
    return materialize(vocab, "nb-vocab"), spark.createDataFrame(priors.collect(), priors.schema)


def naive_bayes_predict(test_tf: DataFrame, test_docs: DataFrame, doc_id: str, vocab: DataFrame,
                        priors: DataFrame, label: str, classes: list | None = None,
                        unseen_idf: float | None = None) -> DataFrame:
    """(doc_id, prediction): argmax over classes of
    log_prior + Σ_j x_j log P(j | class), x = tf × idf over training tokens.

    Rewritten as log_prior + unseen × Σ_j x_j + Σ_j x_j delta_j, the score
    needs one join of the documents' term frequencies with the vocabulary
    table (hot tokens split off, see ``split_hot_join``) and one
    per-document aggregation with K sums.  Ties go to the first class, as in
    Spark ML.  ``test_docs`` lists every document to score, so one without
    any training token is still scored (by its prior).  ``unseen_idf``: weight
    of features that no training document has (a hashed feature space knows
    them); by default they do not count.
    """
    tf = test_tf.select(doc_id, "token", "tf")
    model = materialize(vocab.join(document_frequency(tf), "token"), "nb-scored-vocab")
    x = split_hot_join(tf, model, "token", "df", total_rows=tf.count())
    pri = {r[label]: (r["log_prior"], r["log_prob_unseen"]) for r in priors.collect()}  # one row per class
    classes = sorted(pri) if classes is None else classes
    k = len(classes)
    sums = x.groupBy(doc_id).agg(
        F.sum(F.col("tf") * F.col("idf")).alias("_x"),
        *[F.sum(F.col("tf") * F.col("idf") * F.col(f"delta_{i}")).alias(f"_c{i}") for i in range(k)],
        F.sum("tf").alias("_seen"),
    )
    if unseen_idf is not None:
        every = tf.groupBy(doc_id).agg(F.sum("tf").alias("_all"))
        sums = every.join(sums, doc_id, "left").fillna(0).withColumn("_x", F.col("_x") + (F.col("_all") - F.col("_seen")) * F.lit(unseen_idf)).drop("_all")
    scores = [
        F.lit(pri[c][0]) + F.lit(pri[c][1]) * F.col("_x") + F.col(f"_c{i}") for i, c in enumerate(classes)
    ]
    all_docs = test_docs.select(doc_id).join(sums, doc_id, "left").fillna(0.0)
    best = F.lit(classes[0])
    best_score = scores[0]
    for i in range(1, k):
        better = scores[i] > best_score
        best = F.when(better, F.lit(classes[i])).otherwise(best)
        best_score = F.greatest(best_score, scores[i])
    return all_docs.select(doc_id, best.alias("prediction"))
