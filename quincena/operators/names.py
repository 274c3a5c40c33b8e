"""English names of names that have no entry in the dictionary: a name that
can be cut into phrases of the dictionary is translated phrase by phrase."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def words_of(name: str) -> Column:
    """Words of a name: runs of characters other than blanks."""
    return F.filter(F.split(F.col(name), r"\s+"), lambda w: w != "")


def phrase_table(translations: DataFrame) -> DataFrame:
    """Phrases of the dictionary, words joined by one space: ``phrase, size
    (words), english``. Entries without words or without English are no
    phrases; of several entries of one phrase the least English one counts."""
    words = words_of("spanish")
    return (translations.where(F.col("english").isNotNull())
            .select(F.array_join(words, " ").alias("phrase"), F.size(words).alias("size"), "english")
            .where(F.col("size") > 0)
            .groupBy("phrase", "size").agg(F.min("english").alias("english")))


def _cut(n_words: Column, found: Column) -> Column:
    """For each start the longest phrase from which the rest can be cut as
    well (NULL: none). ``found`` holds (start, size, english); phrases are met
    from the last start to the first, at one start from the shortest to the
    longest, so a longer one replaces a shorter one."""
    none = F.lit(None).cast("struct<size: int, english: string>")
    ends = F.struct(F.lit(0).alias("size"), F.lit("").alias("english"))
    start = F.concat(F.array_repeat(none, n_words), F.array(ends))
    ordered = F.sort_array(F.transform(found, lambda m: F.struct(
        (-m["start"]).alias("back"), m["size"].alias("size"), m["english"].alias("english"))))

    def meet(cut: Column, m: Column) -> Column:
        at = -m["back"]
        piece = F.struct(m["size"].alias("size"), m["english"].alias("english"))
        return F.when(F.get(cut, at + m["size"]).isNull(), cut).otherwise(
            F.transform(cut, lambda old, i: F.when(i == at, piece).otherwise(old)))

    return F.aggregate(ordered, start, meet)


def _read_off(cut: Column) -> Column:
    """English of the pieces met when one goes from start to start."""
    first = F.struct(F.lit(0).alias("next"), F.array().cast("array<string>").alias("parts"))

    def step(state: Column, i: Column) -> Column:
        piece = F.get(cut, i)
        return F.when(state["next"] != i, state).otherwise(F.struct(
            (i + piece["size"]).alias("next"), F.array_append(state["parts"], piece["english"]).alias("parts")))

    walked = F.aggregate(F.sequence(F.lit(0), F.size(cut) - 2), first, step)
    return F.array_join(F.filter(walked["parts"], lambda p: p != ""), " ")


def cut_into_phrases(names: DataFrame, name_col: str, translations: DataFrame, out_col: str) -> DataFrame:
    """``name_col, out_col`` of the distinct names that can be cut into
    phrases of the dictionary, from the first word to the last.

    From the left the longest phrase is taken after which the rest can be cut
    as well, so a phrase that leads nowhere gives way to a shorter one. Blanks
    only part words. A phrase whose English is empty adds nothing.

    Each name meets the dictionary by its runs of words of the sizes that
    phrases have, in an equi-join; the cut is made within the name's own row.
    Its cost goes with the square of a name's words."""
    phrases = phrase_table(translations)
    sizes = phrases.agg(F.collect_set("size")).scalar()  # distinct word counts of phrases: a few
    words = (names.select(name_col).where(F.col(name_col).isNotNull()).distinct()
             .withColumn("_words", words_of(name_col)))
    runs = (words.select(name_col, "_words", F.posexplode("_words").alias("_start", "_word"), sizes.alias("_sizes"))
            .select(name_col, "_words", "_start", F.explode(F.filter(
                "_sizes", lambda n: n <= F.size("_words") - F.col("_start"))).alias("_size"))
            .select(name_col, F.size("_words").alias("_n"), "_start", "_size",
                    F.array_join(F.slice("_words", F.col("_start") + 1, F.col("_size")), " ").alias("_phrase")))
    found = runs.join(phrases.select(F.col("phrase").alias("_phrase"), F.col("english").alias("_english")), "_phrase")
    cut = (found.groupBy(name_col, "_n").agg(F.collect_list(F.struct(
        F.col("_start").alias("start"), F.col("_size").alias("size"), F.col("_english").alias("english"))).alias("_found"))
        .withColumn("_cut", _cut(F.col("_n"), F.col("_found")))
        .where(F.get("_cut", F.lit(0)).isNotNull()))
    return cut.select(name_col, _read_off(F.col("_cut")).alias(out_col))


def translate_phrases(df: DataFrame, name_col: str, translations: DataFrame, out_col: str) -> DataFrame:
    """``df`` with ``out_col``: the English of the name's own entry, else of
    the phrases that it can be cut into, else NULL. Takes the place of
    ``dims.translate`` wherever a ``translate`` function is a parameter."""
    whole = (translations.where(F.col("spanish").isNotNull())
             .groupBy(F.col("spanish").alias(name_col)).agg(F.min("english").alias(out_col)))
    composed = cut_into_phrases(df.join(whole.where(F.col(out_col).isNotNull()), name_col, "left_anti"),
                                name_col, translations, "_composed")
    return (df.join(whole, name_col, "left").join(composed, name_col, "left")
            .withColumn(out_col, F.coalesce(out_col, "_composed")).drop("_composed"))
