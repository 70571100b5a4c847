"""Variant groups of values and removal of near-duplicate rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.functions.kinds import TEXT, col, converted, kind_of, require
from sluice.operators.joins import unused
from sluice.operators.ordering import order_keys
from sluice.operators.rows import keep_first
from sluice.session import materialize, settled

METHODS = ("spelling", "phonetic", "patterns", "tfidf")
# texts of a word that one part of it compares with all others
MET_TEXTS = 2048
# fixed values: words that say what kind of entity a name is, not which one
ENTITY_WORDS = (
    "inc", "incorporated", "corp", "corporation", "co", "company", "ltd", "limited",
    "llc", "llp", "lp", "plc", "gmbh", "ag", "sa", "bv", "the", "group", "holdings",
)


def normalized(text: Column) -> Column:
    """Lower case, letters and digits only, single blanks."""
    plain = F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " ")
    return F.trim(plain)


def near_pairs(values: DataFrame, max_edits: int) -> DataFrame:
    """All pairs of distinct texts at most ``max_edits`` (1 or 2) edits apart, exactly.

    Two texts within that distance share a text that deleting up to as many
    characters from each leaves. Joining on the hash of those shortened texts
    meets only texts at most twice as far apart, so the number of partners
    of a text is bounded by its length and alphabet and not by the table.
    Meant for names, codes and addresses: the keys of a text grow with its
    length to the power of ``max_edits``.
    """
    if max_edits not in (1, 2):
        raise ValueError(f"max_edits is 1 or 2, not {max_edits}")

    def shortened(text: Column) -> Column:
        places = F.sequence(F.lit(1), F.length(text))
        cut = F.transform(
            places,
            lambda i: F.concat(F.left(text, i - 1), F.substring(text, i + 1, F.length(text))),
        )
        return F.when(F.length(text) > 0, cut).otherwise(F.array().cast("array<string>"))

    texts = F.array_union(F.array("text"), shortened(F.col("text")))
    if max_edits == 2:
        twice = F.flatten(F.transform(shortened(F.col("text")), shortened))
        texts = F.array_union(texts, twice)
    keys = values.select("text", F.explode(F.array_distinct(texts)).alias("short")).select(
        "text", F.xxhash64("short").alias("key")
    )
    other = keys.withColumnRenamed("text", "other")
    close = F.levenshtein("text", "other", max_edits)
    return (
        keys.join(other, "key")
        .filter((F.col("text") < F.col("other")) & (close >= 0))
        .select("text", "other", close.alias("edits"))
        .distinct()
    )


def edit_pairs(values: DataFrame, min_similarity: float) -> DataFrame:
    """All pairs of distinct texts with ``1 - edits / longer length`` of at least ``min_similarity``, exactly.

    The longer text of a pair is cut into one segment more than the edits its
    length allows, so one of them is untouched and lies in the shorter text, no
    further from its place than the edits left and right of it. Texts of all
    lengths meet by these segments, and candidates are verified within the bound.
    The keys of a text grow with the square of the edits it may have, not with
    its length.
    """
    if not 0 < min_similarity <= 1:
        raise ValueError(f"min_similarity lies above 0 and not above 1, not {min_similarity}")
    share = F.lit(1 - min_similarity + 1e-12)
    texts = settled(values.select("text", F.length("text").cast("int").alias("size")).distinct(), "texts")
    edits = F.floor(share * F.col("long")).cast("int")
    place, length = F.col("place"), F.col("length")

    def segments(edits: Column) -> Column:
        """Number, place from 0 and length of the parts of a text of length ``long``."""
        base, larger = F.call_function("div", F.col("long"), edits + 1).cast("int"), F.col("long") % (edits + 1)
        small = edits + 1 - larger
        return F.transform(
            F.sequence(F.lit(0), edits),
            lambda i: F.struct(i.alias("i"), (i * base + F.greatest(F.lit(0), i - small)).alias("place"), (base + (i >= small).cast("int")).alias("length")),
        )

    key = lambda text: F.xxhash64("long", "i", text)
    parts = texts.filter("size > 0").withColumnRenamed("size", "long").withColumn("edits", edits).select("text", "long", "edits", F.inline(segments(F.col("edits"))))
    kept = parts.select(F.col("text").alias("other"), "edits", key(F.substring("text", place + 1, length)).alias("key"))
    # lengths that a longer partner may have, of those that there are
    lengths = texts.select(F.col("size").alias("long")).distinct()
    reach = F.sequence(F.col("size"), F.floor(F.col("size") / min_similarity + 1e-9).cast("int"))
    probes = texts.filter("size > 0").select("text", "size", F.explode(reach).alias("long")).join(lengths, "long")
    probes = probes.withColumn("edits", edits).filter(F.col("long") - F.col("size") <= F.col("edits"))
    probes = probes.select("text", "size", "long", "edits", F.inline(segments(F.col("edits"))))
    more = F.col("long") - F.col("size")
    low = F.greatest(F.lit(0), place - F.col("i"), place - more - (F.col("edits") - F.col("i")))
    high = F.least(F.col("size") - length, place + F.col("i"), place - more + F.col("edits") - F.col("i"))
    found = F.when(low <= high, F.transform(F.sequence(low, high), lambda p: key(F.substring("text", p + 1, length))))
    asked = probes.select("text", F.explode(F.array_distinct(found)).alias("key"))
    met = asked.join(kept, "key").filter(
        (F.length("text") < F.length("other")) | ((F.length("text") == F.length("other")) & (F.col("text") < F.col("other")))
    )
    # -1 beyond the bound, without looking further
    close = F.call_function("levenshtein", F.col("text"), F.col("other"), F.col("edits"))
    verified = met.select("text", "other", "edits").distinct().withColumn("found", close).filter("found >= 0")
    return verified.select(F.least("text", "other").alias("text"), F.greatest("text", "other").alias("other"), F.col("found").alias("edits"))


def cosine_pairs(values: DataFrame, min_similarity: float) -> DataFrame:
    """All pairs of distinct texts whose words, weighted by rarity, have a cosine of at least ``min_similarity``.

    A word weighs its count in the text times ``ln(1 + texts / texts with it)``.
    Words of a text are taken rarest first, as many as are needed for the rest to
    be shorter than the bound: two texts as similar as that share one of these.
    So a word that half of the texts have brings no candidates, unless a text has
    little else. Candidates are verified where they meet, by vectors that travel
    with each of these words: meant for names, titles and other short texts.
    """
    if not 0 < min_similarity <= 1:
        raise ValueError(f"min_similarity lies above 0 and not above 1, not {min_similarity}")
    texts = values.select("text").distinct()
    words = texts.select("text", F.explode(F.split(normalized(F.col("text")), " ")).alias("word")).filter("word <> ''")
    counted = words.groupBy("text", "word").agg(F.count(F.lit(1)).alias("tf"))
    spread = counted.groupBy("word").agg(F.count(F.lit(1)).alias("texts"))
    total = texts.agg(F.count(F.lit(1))).scalar()
    weighted = counted.join(spread, "word").withColumn("weight", F.col("tf") * F.log1p(total / F.col("texts")))
    whole = Window.partitionBy("text")
    vectors = weighted.withColumn("weight", F.col("weight") / F.sqrt(F.sum(F.col("weight") ** 2).over(whole)))
    vectors = materialize(vectors.select("text", "word", "texts", "weight"), "vectors")
    # what is left of the vector from each word on
    rest = F.sum(F.col("weight") ** 2).over(whole.orderBy(F.desc("texts"), F.desc("word")).rowsBetween(Window.unboundedPreceding, 0))
    first = vectors.withColumn("rest", rest).filter(F.col("rest") >= min_similarity**2 - 1e-9).select("text", "word")
    # the whole vector goes along, so that candidates are verified where they meet and only similar ones are kept
    whole = vectors.groupBy("text").agg(F.map_from_entries(F.collect_list(F.struct("word", "weight"))).alias("vector"))
    shared = first.groupBy("word").agg((F.floor(F.count(F.lit(1)) / MET_TEXTS) + 1).cast("int").alias("parts")).filter("parts > 1")
    first = materialize(first.join(whole, "text").join(shared, "word", "left").fillna(1, ["parts"]), "first-words")
    # a word with many texts is met in parts; tasks are few rows but many candidates, so they are not put together
    tasks = int(values.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    mine = first.select("word", F.pmod(F.xxhash64("text"), "parts").cast("int").alias("part"), "text", "vector")
    yours = first.select("word", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("text").alias("other"), F.col("vector").alias("other_vector"))
    met = mine.repartition(tasks, "word", "part").join(yours.repartition(tasks, "word", "part"), ["word", "part"]).filter(F.col("text") < F.col("other"))
    product = F.aggregate(
        F.map_entries("vector"), F.lit(0.0), lambda total, x: total + x["value"] * F.coalesce(F.try_element_at("other_vector", x["key"]), F.lit(0.0))
    )
    similar = met.select("text", "other", F.round(product, 9).alias("similarity")).filter(F.col("similarity") >= min_similarity)
    return similar.dropDuplicates(["text", "other"])


def suggest_replacements(
    df: DataFrame,
    column: str,
    method: str = "spelling",
    max_edits: int = 1,
    common_share: float = 0.2,
    min_similarity: float | None = None,
) -> DataFrame:
    """Variants of a column's values with the value that should replace them.

    The suggestion is the most frequent value of the group, the first in order
    among equally frequent ones. Groups are values within some edits
    (spelling), that sound alike (phonetic), that differ in entity words and
    punctuation (patterns), or that share all words except common ones (tfidf).
    With ``min_similarity`` spelling and tfidf suggest the best of the values
    that are as similar as that: by edits and length, or by weighted words.
    Feed the result to ``bulk_replace_from``.
    """
    require(df, column)
    if method not in METHODS:
        raise ValueError(f"method is one of {METHODS}, not {method!r}")
    text = converted(col(column), kind_of(df, column), TEXT)
    counts = (
        df.select(text.alias("text"))
        .filter("text is not null")
        .groupBy("text")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    if min_similarity is not None and method not in ("spelling", "tfidf"):
        raise ValueError(f"{method!r} has no similarity")
    if method == "spelling":
        texts = counts.select("text")
        return _best_near(counts, near_pairs(texts, max_edits) if min_similarity is None else edit_pairs(texts, min_similarity))
    if method == "tfidf" and min_similarity is not None:
        return _best_near(counts, cosine_pairs(counts, min_similarity))
    if method == "tfidf":
        keyed = _rare_words(counts, common_share)
    else:
        words = F.split(normalized(F.col("text")), " ")
        if method == "phonetic":
            # a word without a sound code, such as a number, stands for itself
            coded = F.transform(words, lambda w: F.soundex(w))
        else:
            coded = F.filter(words, lambda w: ~w.isin(list(ENTITY_WORDS)))
        keyed = counts.withColumn("key", F.array_join(coded, " "))
    # most frequent first, then the smallest text: one pass of partial maxima
    best = keyed.groupBy("key").agg(F.max("n").alias("most"))
    firsts = (
        keyed.join(best, "key").filter("n = most").groupBy("key").agg(F.min("text").alias("suggested"))
    )
    return (
        keyed.join(firsts, "key")
        .filter("text <> suggested and key <> ''")
        .select(F.col("text").alias("variant"), "suggested", F.col("n").alias("occurrences"))
    )


def _best_near(counts: DataFrame, pairs: DataFrame) -> DataFrame:
    """For each value the most frequent of those it is near to, if that is more frequent."""
    both = pairs.select("text", "other").union(pairs.select("other", "text"))
    other = counts.select(F.col("text").alias("other"), F.col("n").alias("other_n"))
    ranked = both.join(counts, "text").join(other, "other")
    better = (F.col("other_n") > F.col("n")) | (
        (F.col("other_n") == F.col("n")) & (F.col("other") < F.col("text"))
    )
    return (
        ranked.filter(better)
        .groupBy("text", "n")
        .agg(F.min_by("other", F.struct(-F.col("other_n"), F.col("other"))).alias("suggested"))
        .select(F.col("text").alias("variant"), "suggested", F.col("n").alias("occurrences"))
    )


def _rare_words(counts: DataFrame, common_share: float) -> DataFrame:
    """Key of a value: its words without those found in too many of the values."""
    words = F.array_distinct(F.split(normalized(F.col("text")), " "))
    long = counts.select("text", "n", F.explode(words).alias("word"))
    spread = long.groupBy("word").agg(F.count(F.lit(1)).alias("values_with"))
    total = counts.agg(F.count(F.lit(1))).scalar()
    common = spread.filter(F.col("values_with") > total * common_share).select("word")
    kept = long.join(common, "word", "left_anti")
    key = F.array_join(F.array_sort(F.collect_list("word")), " ")
    return kept.groupBy("text", "n").agg(key.alias("key"))


def dedupe_fuzzy(
    df: DataFrame,
    columns: Sequence[str],
    order_by: Sequence,
    max_edits: int | None = 1,
    min_similarity: float = 0.0,
) -> DataFrame:
    """Keep the first row of every group of rows whose key texts are nearly equal.

    Two texts are near when at most ``max_edits`` edits apart (1, 2, or None for
    any number), at a similarity of ``1 - edits / length`` of at least
    ``min_similarity``; groups are closed under nearness. Equal texts are one value throughout, so copies cost nothing.
    """
    require(df, *columns)
    parts = [converted(col(c), kind_of(df, c), TEXT) for c in columns]
    text = normalized(F.concat_ws(" ", *parts))
    names = df.columns
    own, label, group = (unused(n, names) for n in ("_text", "_label", "_group"))
    everything = df.withColumn(own, text)
    # nothing to compare in a blank key: such rows are no one's duplicates
    keyed = everything.filter(F.col(own) != "")
    values = keyed.select(F.col(own).alias("text")).distinct()
    longest = F.greatest(F.length("text"), F.length("other"))
    if max_edits is None:
        pairs = edit_pairs(values, min_similarity)
    else:
        pairs = near_pairs(values, max_edits).filter(
            1 - F.col("edits") / longest >= F.lit(float(min_similarity))
        )
    groups = smallest_connected(pairs.select("text", "other")).toDF(own, label)
    labelled = keyed.join(groups, own, "left").withColumn(group, F.coalesce(label, own))
    kept = keep_first(labelled, [group], order_keys(df, order_by, needed_by="dedupe_fuzzy"))
    blank = everything.filter(F.col(own) == "").drop(own)
    return kept.drop(own, label, group).unionByName(blank)


def smallest_connected(pairs: DataFrame) -> DataFrame:
    """The smallest text each text is connected to, over any number of steps.

    Alternates linking every neighbour, then every smaller neighbour, of a text
    to the smallest one, until nothing changes: few rounds even for long chains.
    Each round is written to the shared folder.
    """
    links = materialize(pairs.toDF("a", "b").filter("a <> b"), "links")
    before = None
    while True:
        links = materialize(_star(_star(links, True), False), "links")
        # an order-free fingerprint of the links; equal twice means settled
        state = links.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if state == before:
            return links.select(F.col("a").alias("_text"), F.col("b").alias("_label"))
        before = state


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Link neighbours of each text to the smallest text around it."""
    ways = links.select("a", "b")
    if large:
        ways = ways.union(links.select("b", "a"))
    else:
        ways = ways.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    ways = ways.distinct()
    small = ways.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
    joined = ways.join(small, "a")
    if large:
        moved = joined.filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    else:
        moved = joined.select(F.col("b").alias("a"), F.col("low").alias("b")).union(
            joined.select("a", F.col("low").alias("b"))
        )
    return moved.filter("a <> b").distinct()
