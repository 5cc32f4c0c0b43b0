"""Quality rules: base counts, and distance from the language's usual histograms.

Every text gives two histograms: characters by class, and the common words of
its language with all other words as one more bin.  The sums over all documents
of a language are its references.  A document is kept if the Jensen-Shannon
distance (base 2, 0 to 1) of both histograms from the references is small: that of
the words beside the distance of a text without any common word of the language,
which is the greatest that a text of other words can have.  Texts below the least
length are not judged by that histogram.

Only DataFrame functions are used.  A text never leaves its row: windows of
words are compared as 64-bit hashes inside the row, and only counts per document
reach the aggregation by language.

* null or empty text: no words, so the base rule fails it and it is not kept;
* null or unlisted language: its words are all one bin and carry no judgement;
  characters are compared with the documents of the same null or unlisted value;
* repeated rows are judged alike; an empty table gives an empty one; only
  ``doc_id``, ``text`` and ``lang`` are looked at.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kilnstream.sources.shared import shared_folder

SPACE = r"[\x20\x09-\x0D]+"
WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED_PERCENT = 30
#: Texts with fewer characters or words are not judged by that histogram.
LEAST_CHARS = 200
LEAST_JUDGED_WORDS = 80
#: Greatest distance from the references of the language; that of the words as a share
#: of the distance of a text without common words.
MOST_CHAR_DISTANCE = 0.25
MOST_WORD_SHARE = 0.9

#: Common words of each language.
COMMON_WORDS = {
    "en": ["the", "of", "and", "to", "in", "is", "that", "for", "it", "was", "with", "be"],
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est"],
    "es": ["de", "la", "que", "el", "en", "y", "a", "los", "se", "del", "las", "un"],
}
N_COMMON = 12
#: The histogram of a text without common words.
NO_COMMON = f"array({'0L, ' * N_COMMON}1L)"
#: Character classes, each counted among what the ones before have left over.
CHAR_CLASSES = ["[a-z]+", SPACE, "[A-Z]+", "[0-9]+", r"[\x21-\x7E]+", r"\p{L}+"]


def once(rows: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that later steps read instead of computing them again."""
    fields = [column.alias(name) for name, column in columns.items()]
    return rows.select("*", F.inline(F.array(F.struct(*fields))))


def window_hashes(rows: DataFrame) -> DataFrame:
    """Hash of the 8 words from each place: pairs, then pairs of pairs, and again."""
    rows = once(rows, h=F.transform("w", lambda word: F.xxhash64(word)))
    for width in (1, 2, 4):
        following = "transform(h, (x, i) -> xxhash64(x, get(h, i + {0})))".format(width)
        rows = once(rows, longer=F.expr(following)).drop("h").withColumnRenamed("longer", "h")
    return once(
        rows.withColumn("h", F.expr(f"slice(h, 1, greatest(n_words - {WINDOW - 1}, 0))")),
        repeats=F.expr("size(array_distinct(h)) < size(h)"),
    )


def repeated_words(rows: DataFrame) -> DataFrame:
    """``n_repeat_words``: words in windows that stand in the text twice or more.

    Only texts with such a window sort theirs.
    """
    rows = once(window_hashes(rows), s=F.expr(
        "if(repeats, sort_array(transform(h, (x, i) -> named_struct('h', x, 'i', i))), NULL)"
    )).drop("h", "repeats")
    rows = once(rows, p=F.expr(
        "sort_array(transform(filter(s, (x, i) -> x.h <=> get(s, i - 1).h"
        " OR x.h <=> get(s, i + 1).h), x -> x.i))"
    )).drop("s")
    return once(rows, n_repeat_words=F.expr(
        f"coalesce(aggregate(transform(p, (x, i) -> least({WINDOW}, coalesce("
        f"get(p, i + 1) - x, {WINDOW}))), 0L, (total, n) -> total + n), 0L)"
    )).drop("p")


def char_counts(rows: DataFrame) -> DataFrame:
    """``chars``: characters of each class and of none; ``rest`` holds what is left to count."""
    rows = once(rows, rest=F.col("t"))
    for number, pattern in enumerate(CHAR_CLASSES):
        rows = once(rows, left=F.regexp_replace("rest", pattern, ""))
        rows = once(rows, **{f"c{number}": F.length("rest") - F.length("left")})
        rows = rows.drop("rest").withColumnRenamed("left", "rest")
    names = [f"c{number}" for number in range(len(CHAR_CLASSES))]
    rows = once(rows, chars=F.array(*[F.col(name).cast("bigint") for name in names],
                                    F.length("rest").cast("bigint")))
    return rows.drop("rest", *names)


def common_counts(rows: DataFrame) -> DataFrame:
    """``common``: the common words of the row's language, then all others."""
    listed = F.lit(None).cast("array<string>")
    for lang, common in COMMON_WORDS.items():
        listed = F.when(F.col("lang") == lang, F.array(*map(F.lit, common))).otherwise(listed)
    every = ", ".join(f"'{word}'" for word in sorted(set(sum(COMMON_WORDS.values(), []))))
    rows = once(rows, f=F.expr(f"filter(w, x -> x IN ({every}))"), listed=listed)
    rows = once(rows, found=F.expr(
        "transform(listed, c -> cast(size(filter(f, x -> x = c)) AS bigint))"
    ))
    return once(rows, common=F.expr(
        "concat(found, array(n_words - aggregate(found, 0L, (total, n) -> total + n)))"
    )).drop("f", "listed", "found")


def counts(docs: DataFrame) -> DataFrame:
    """The base counts and both histograms of every document, without its text."""
    rows = docs.select("doc_id", "lang", F.coalesce("text", F.lit("")).alias("t"))
    rows = once(rows, w=F.array_remove(F.split("t", SPACE), ""))
    rows = once(rows, n_words=F.size("w").cast("bigint"),
                lines=F.filter(F.split("t", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")))
    rows = once(
        rows,
        word_chars=F.length(F.array_join("w", "")).cast("bigint"),
        n_symbols=F.length(F.regexp_replace("t", r"[^#*$%&|<>]+", "")).cast("bigint"),
        n_dup_lines=(F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint"),
    ).drop("lines")
    rows = char_counts(common_counts(rows)).drop("t")
    return repeated_words(rows).drop("w")


def references(counted: DataFrame) -> DataFrame:
    """Summed histograms of each language, over all its documents."""
    def summed(name: str, size: int) -> Column:
        return F.array(*[F.sum(F.get(name, F.lit(at))) for at in range(size)])

    return counted.groupBy(F.col("lang").alias("ref_lang")).agg(
        summed("chars", len(CHAR_CLASSES) + 1).alias("ref_chars"),
        summed("common", N_COMMON + 1).alias("ref_common"),
    )


def distance(own: str, reference: str) -> Column:
    """Jensen-Shannon distance of two count arrays; null if either has no counts."""
    def share(name: str) -> str:
        total = f"aggregate({name}, 0L, (total, n) -> total + n)"
        return f"transform({name}, n -> CAST(n AS double) / nullif({total}, 0))"

    part = "if({0} > 0, {0} * log2(2 * {0} / (p + q)), 0D)"
    terms = f"zip_with({share(own)}, {share(reference)}, (p, q) -> " \
            f"{part.format('p')} + {part.format('q')})"
    return F.expr(
        f"sqrt(greatest(aggregate({terms}, 0D, (total, x) -> total + x) / 2, 0D))"
    )


def judge(
    docs: DataFrame,
    most_char_distance: float = MOST_CHAR_DISTANCE,
    most_word_share: float = MOST_WORD_SHARE,
) -> DataFrame:
    """Base counts, distances and verdict of every document."""
    folder = shared_folder(docs.sparkSession)
    measured = counts(docs)
    measured.write.parquet(folder)
    measured = docs.sparkSession.read.schema(measured.schema).parquet(folder)
    compared = measured.join(
        references(measured), F.col("lang").eqNullSafe(F.col("ref_lang")), "left"
    )
    compared = compared.withColumns({
        "char_distance": distance("chars", "ref_chars"),
        "word_distance": distance("common", "ref_common"),
        "no_common_distance": distance(NO_COMMON, "ref_common"),
    })
    n_chars = F.expr("aggregate(chars, 0L, (total, n) -> total + n)")
    strange = (
        ((n_chars >= LEAST_CHARS) & (F.col("char_distance") > most_char_distance))
        | ((F.col("n_words") >= LEAST_JUDGED_WORDS)
           & (F.col("word_distance") > most_word_share * F.col("no_common_distance")))
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")
    )
    return compared.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & ~F.coalesce(strange, F.lit(False))).alias("kept"),
    )


def op4_quality_rules(spark, sf_dir) -> DataFrame:
    return judge(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _listed() -> str:
    cases = " ".join(
        f"WHEN '{lang}' THEN {words!r}" for lang, words in COMMON_WORDS.items()
    )
    return f"CASE lang {cases} END"


def _distance(own: str, reference: str) -> str:
    def share(name: str) -> str:
        return f"list_transform({name}, lambda n: n::DOUBLE / nullif(list_sum({name}), 0))"

    term = "CASE WHEN x[{0}] > 0 THEN x[{0}] * log2(2 * x[{0}] / (x[1] + x[2])) ELSE 0 END"
    return (f"sqrt(greatest(list_sum(list_transform(list_zip({share(own)}, {share(reference)}), "
            f"lambda x: {term.format(1)} + {term.format(2)})) / 2, 0))")


def _chars() -> str:
    left, parts = "t", []
    for pattern in CHAR_CLASSES:
        rest = f"regexp_replace({left}, '{pattern}', '', 'g')"
        parts.append(f"length({left}) - length({rest})")
        left = rest
    return f"[{', '.join(parts)}, length({left})]"


def _summed(name: str, size: int) -> str:
    return "[" + ", ".join(f"sum({name}[{at}])::BIGINT" for at in range(1, size + 1)) + "]"


ORACLE = rf"""
WITH base AS (
  SELECT doc_id, lang, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)),
      lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines, {_listed()} AS listed
  FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(list_slice(w, i, i + {WINDOW - 1}), ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM base)
), twice AS (
  SELECT doc_id, g FROM windows GROUP BY ALL HAVING count(*) > 1
), repeated AS (
  SELECT doc_id, count(DISTINCT n) AS n FROM (
    SELECT doc_id, unnest(range(i, i + {WINDOW})) AS n FROM windows JOIN twice USING (doc_id, g)
  ) GROUP BY 1
), counted AS (
  SELECT doc_id, lang, len(w) AS n_words, len(array_to_string(w, '')) AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words,
    {_chars()} AS chars,
    list_transform(listed, lambda c: len(list_filter(w, lambda x: x = c))) AS found
  FROM base LEFT JOIN repeated r USING (doc_id)
), both_histograms AS (
  SELECT *, CASE WHEN found IS NOT NULL
    THEN list_append(found, n_words - list_sum(found)) END AS common,
    [{'0, ' * N_COMMON}1] AS no_common FROM counted
), refs AS (
  SELECT lang AS ref_lang, {_summed('chars', len(CHAR_CLASSES) + 1)} AS ref_chars,
    {_summed('common', N_COMMON + 1)} AS ref_common
  FROM both_histograms GROUP BY 1
), compared AS (
  SELECT *, {_distance('chars', 'ref_chars')} AS char_distance,
    {_distance('common', 'ref_common')} AS word_distance,
    {_distance('no_common', 'ref_common')} AS no_common_distance,
    n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED_PERCENT} * n_words
      AS base_failed
  FROM both_histograms LEFT JOIN refs ON lang IS NOT DISTINCT FROM ref_lang
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars,
  n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
  n_repeat_words::BIGINT AS n_repeat_words, base_failed,
  NOT base_failed AND NOT coalesce(
    (list_sum(chars) >= {LEAST_CHARS} AND char_distance > {MOST_CHAR_DISTANCE})
    OR (n_words >= {LEAST_JUDGED_WORDS} AND word_distance > {MOST_WORD_SHARE} * no_common_distance), false) AS kept
FROM compared
"""
