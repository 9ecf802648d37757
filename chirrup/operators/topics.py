"""Term counts, TF-IDF tables, topics and entities per event.

Documents are tokenised once, counted inside their own row, and shuffled once
by document key. Term frequencies, the join to the vocabulary and the vector
norms then stay in that partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from chirrup import params as P
from chirrup.functions import cleaning as C, text as X
from chirrup.functions.arrays import one_row_each
from chirrup.operators.ranking import small_side, top_per_group
from chirrup.session import written


def with_terms(df: DataFrame, text: str, params: P.TfidfParams, name: str = "terms") -> DataFrame:
    """Add the term array of a text under the vectoriser settings.

    Tokens get a step of their own, so n-grams read a finished array.
    """
    low, high = params.ngrams
    if params.analyzer == "char":
        return df.withColumn(name, X.char_ngrams(text, low, high))
    tokens = df.withColumn("_tokens", X.word_tokens(text))
    return tokens.withColumn(name, X.word_ngrams(F.col("_tokens"), low, high)).drop("_tokens")


def count_terms(df: DataFrame, terms: Column, name: str = "counted") -> DataFrame:
    """Replace a row's term array by an array of (term, tf), inside the row.

    The sorted array is cut where a term differs from the one before it; the
    distance to the next cut is the term's count. No shuffle is involved.
    """
    sorted_terms = df.withColumn("_s", F.sort_array(terms))
    s = F.col("_s")
    starts = F.filter(
        F.sequence(F.lit(1), F.greatest(F.size(s), F.lit(1))),
        lambda i: (F.size(s) > 0) & ((i == 1) | (F.get(s, i - 1) != F.get(s, i - 2))),
    )
    cut = sorted_terms.withColumn("_at", starts)
    at = F.col("_at")
    counted = F.transform(
        at,
        lambda start, j: F.struct(
            F.get(s, start - 1).alias("term"),
            (F.coalesce(F.get(at, j + 1), F.size(s) + 1) - start).cast("bigint").alias("tf"),
        ),
    )
    return cut.withColumn(name, counted).drop("_s", "_at")


def term_frequencies(
    docs: DataFrame, key: str, text: str, params: P.TfidfParams, keep: Sequence[str] = (), spread: bool = False
) -> DataFrame:
    """Long table (key, term, tf).

    With `spread`, terms are counted inside the row and the result is hashed by
    the key alone, for joins and windows per document. Otherwise (vocabularies)
    a generated hash aggregation counts them, complete per document map-side.
    """
    termed = with_terms(docs.select(key, *keep, text), text, params, "_terms")
    if not spread:
        rows = one_row_each(termed, [key, *keep], F.col("_terms"), "term")
        return rows.groupBy(key, *keep, "term").agg(F.count(F.lit(1)).alias("tf"))
    arrays = count_terms(termed, F.col("_terms")).select(key, *keep, "counted").repartition(key)
    return one_row_each(arrays, [key, *keep], F.col("counted"), "c").select(key, *keep, "c.*")


def document_frequency(tf: DataFrame) -> DataFrame:
    """Documents and occurrences per term; combined map-side."""
    return tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("total"))


def vocabulary(tf: DataFrame, params: P.TfidfParams) -> DataFrame:
    """The most frequent terms above the document floor; ties by term."""
    return most_frequent(document_frequency(tf), params)


def most_frequent(counts: DataFrame, params: P.TfidfParams) -> DataFrame:
    """The same choice from rows that hold (term, df, total)."""
    frequent = counts.filter(F.col("df") >= params.min_df)
    return frequent.orderBy(F.desc("total"), "term").limit(params.max_terms)


def smooth_idf(n: Column, df: Column) -> Column:
    return F.log((1 + n) / (1 + df)) + 1


def tf_weight(tf: Column, sublinear: bool) -> Column:
    return 1 + F.log(tf.cast("double")) if sublinear else tf.cast("double")


def tfidf(docs: DataFrame, key: str, text: str, params: P.TfidfParams = P.WORD_TFIDF, keep: Sequence[str] = ()) -> DataFrame:
    """L2-normalised TF-IDF as a long table (key, term, tf, weight).

    The vocabulary has at most `max_terms` rows, so it is broadcast; only the
    counted documents are shuffled, once, and both uses share that exchange.
    """
    tf = term_frequencies(docs, key, text, params, keep, spread=True)
    n_docs = docs.agg(F.count(F.lit(1)).alias("n")).scalar()
    vocab = vocabulary(tf, params).select("term", smooth_idf(n_docs, F.col("df")).alias("idf"))
    raw = tf.join(F.broadcast(vocab), "term").withColumn("w", tf_weight(F.col("tf"), params.sublinear) * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(key)))
    return raw.select(key, *keep, "term", "tf", (F.col("w") / norm).alias("weight"))


# ----------------------------------------------------------- corpus profiles
def top_tokens(df: DataFrame, text: str, groups: Sequence[str], n: int = 20) -> DataFrame:
    """Most frequent social tokens per class, stop words removed."""
    stops = (*X.english_stop_words(), *P.SOCIAL_STOP_WORDS)
    tokens = X.without_stop_words(X.social_tokens(text), stops)
    counts = one_row_each(df, groups, tokens, "term").groupBy(*groups, "term").agg(
        F.count(F.lit(1)).alias("n")
    )
    return top_per_group(counts, groups, [F.desc("n"), F.col("term")], n)


def top_bigrams(df: DataFrame, text: str, n: int = 20) -> DataFrame:
    """Most frequent pairs of neighbouring social tokens, stop words kept."""
    tokens = df.select(X.social_tokens(text).alias("t"))
    pairs = one_row_each(tokens, [], X.word_ngrams(F.col("t"), 2, 2), "term")
    return pairs.groupBy("term").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "term").limit(n)


def vocabulary_sizes(df: DataFrame, key: str, text: str, floors: Sequence[int] = (1, 2, 3, 5, 10)) -> DataFrame:
    """Number of terms found in at least k documents, for each k."""
    per_doc = one_row_each(df, [key], F.array_distinct(X.social_tokens(text)), "term")
    freq = per_doc.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    names = {str(k): k for k in floors}
    wide = freq.agg(*[F.count_if(F.col("df") >= k).alias(name) for name, k in names.items()])
    return wide.unpivot([], list(names), "min_df", "vocabulary").withColumn("min_df", F.col("min_df").cast("bigint"))


def top_char_ngrams(df: DataFrame, text: str, low: int = 3, high: int = 5, n: int = 50) -> DataFrame:
    """Most frequent character n-grams of padded words.

    The grams of a word depend on the word alone, so words are counted first
    and only distinct words are cut up, each with its count.
    """
    counted = one_row_each(df, [], X.words(F.lower(text)), "word").groupBy("word").agg(
        F.count(F.lit(1)).alias("n")
    )
    grams = one_row_each(counted, ["n"], X.char_ngrams("word", low, high), "term")
    return grams.groupBy("term").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "term").limit(n)


# ------------------------------------------------------------ event context
def event_hours(events: DataFrame) -> DataFrame:
    """One row per event and role: its own hour, and the bucket before it."""
    roles = F.array(
        F.struct(F.lit("current").alias("role"), F.col("timestamp").alias("hour")),
        F.struct(F.lit("previous").alias("role"), F.col("previous_timestamp").alias("hour")),
    )
    return events.select("event_id", F.inline(roles)).filter(F.col("hour").isNotNull())


def event_posts(posts: DataFrame, events: DataFrame) -> DataFrame:
    """Posts beside the events whose bucket they fall in, on the UTC hour.

    The event table is bucket-sized; once its row count is checked it is
    broadcast, so an hour holding most posts needs no shuffle at all.
    """
    hour = F.date_trunc("hour", C.parse_instant("created_at"))
    return posts.withColumn("hour", hour).join(small_side(event_hours(events)), "hour")


def topics_by_event(
    posts: DataFrame, events: DataFrame, params: P.TopicParams = P.TopicParams(), key: str = "post_id", text: str = "text"
) -> DataFrame:
    """Top TF-IDF terms per event and role (current or previous bucket).

    Each bucket is its own corpus: vocabulary cut, idf and norms are per event
    and role. Terms are counted inside the post row before the join, and the
    vocabulary cut is a group limit, so a busy hour is spread over tasks. The
    vocabularies (`max_terms` per event and role) are broadcast after a check of
    their number; otherwise they are joined by term.
    """
    group = ["event_id", "role"]
    cleaned = posts.select(key, "created_at", X.clean_for_topics(X.clean_text(text)).alias("t"))
    usable = cleaned.filter(F.length("t") >= params.min_text_chars)
    tokens = X.without_stop_words(X.topic_tokens("t"), X.english_stop_words())
    with_tokens = usable.withColumn("tokens", tokens)
    with_grams = with_tokens.withColumn("terms", X.word_ngrams(F.col("tokens"), 1, 2))
    counted = count_terms(with_grams, F.col("terms")).select(key, "created_at", "counted")
    # written once: the vocabulary and the scores both read it, and texts are cut into terms once
    placed = written(event_posts(counted, events).select(*group, key, "counted"), "placed-terms")
    tf = one_row_each(placed, [*group, key], F.col("counted"), "c").select(*group, key, "c.*")
    sizes = placed.groupBy(*group).agg(F.count(F.lit(1)).alias("n_posts"))
    freq = tf.groupBy(*group, "term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("total"))
    kept = top_per_group(freq, group, [F.desc("total"), F.col("term")], params.max_terms, "_r")
    vocab = written(kept.join(sizes, group).select(*group, "term", smooth_idf(F.col("n_posts"), F.col("df")).alias("idf")), "event-vocabulary")
    # the few kept terms meet the texts where they are; only weights of kept terms move, to their text's norm
    raw = tf.join(small_side(vocab), [*group, "term"]).withColumn("w", F.col("tf") * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(*group, key)))
    weighted = raw.select(*group, "term", (F.col("w") / norm).alias("weight"))
    scores = weighted.groupBy(*group, "term").agg(F.round(F.sum("weight"), 6).alias("score"))
    return top_per_group(scores, group, [F.desc("score"), F.col("term")], params.top_terms)


def entities_by_event(
    posts: DataFrame, events: DataFrame, params: P.TopicParams = P.TopicParams(), text: str = "text"
) -> DataFrame:
    """Entities per event and role by the number of posts naming them."""
    named = posts.select("created_at", X.entities(text).alias("names"))
    placed = one_row_each(event_posts(named, events), ["event_id", "role"], F.col("names"), "entity")
    counts = placed.groupBy("event_id", "role", "entity").agg(F.count(F.lit(1)).alias("n"))
    frequent = counts.filter(F.col("n") >= params.min_entity_posts)
    return top_per_group(frequent, ["event_id", "role"], [F.desc("n"), F.col("entity")], params.top_entities)


def _joined(ranked: DataFrame, item: Column, name: str) -> DataFrame:
    """Ranked rows to one text per event and role, pivoted on the role."""
    ordered = F.array_sort(F.collect_list(F.struct("rank", item.alias("item"))))
    texts = ranked.groupBy("event_id").pivot("role", ["current", "previous"]).agg(
        F.array_join(F.transform(ordered, lambda x: x["item"]), ", ")
    )
    return texts.select(
        "event_id", F.col("current").alias(f"current_{name}"), F.col("previous").alias(f"previous_{name}")
    )


def event_context(events: DataFrame, posts: DataFrame, topics: DataFrame, named: DataFrame) -> DataFrame:
    """Current beside previous topics and entities for every event."""
    hours = event_hours(events).filter(F.col("role") == "current")
    hour = F.date_trunc("hour", C.parse_instant("created_at"))
    per_hour = posts.groupBy(hour.alias("hour")).agg(F.count(F.lit(1)).alias("bucket_post_count"))
    sizes = hours.join(per_hour, "hour").select("event_id", "bucket_post_count")
    topic_text = _joined(topics, F.col("term"), "topics")
    entity_text = _joined(named, F.format_string("%s (%d)", "entity", "n"), "entities")
    joined = (
        events.select("event_id", "timestamp", "event_type")
        .join(sizes, "event_id", "left")
        .join(topic_text, "event_id", "left")
        .join(entity_text, "event_id", "left")
    )
    texts = ["current_topics", "previous_topics", "current_entities", "previous_entities"]
    return joined.select(
        "event_id", "timestamp", "event_type",
        F.coalesce("bucket_post_count", F.lit(0)).alias("bucket_post_count"),
        *[F.coalesce(t, F.lit("")).alias(t) for t in texts],
    )


def events_with_entities(context: DataFrame) -> DataFrame:
    named = (F.col("current_entities") != "") | (F.col("previous_entities") != "")
    return context.agg(F.count(F.lit(1)).alias("events"), F.count_if(named).alias("with_entities"))
