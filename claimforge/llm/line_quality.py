"""Quality rules with the frequency of lines across the documents of a host, in DataFrame functions only.

Lines are normalised and hashed. A line that more documents of its host hold than a limit
allows is taken out of all of them but the one of least id, and a document that this
leaves with too few words is rejected. Cheap rules on the text alone come before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimforge.llm.decontaminate import _grams, _let
from claimforge.session import materialize

SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
_SPACES = r"[\x20\x09-\x0D]+"
_UPPER, _DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), _SPACES), "")


def repeated_words(words: Column, run: int = 5) -> Column:
    """How many words stand in runs of ``run`` words that the text holds twice or more, the first one included.

    Runs are compared by 64-bit hashes.
    """

    def covered(at: Column) -> Column:
        steps = F.transform(at, lambda p, i: F.least(F.get(at, i + 1) - p, F.lit(run)))  # the last has no next: ``run``
        return F.aggregate(steps, F.lit(0), lambda total, x: total + x)

    def again(placed: Column) -> Column:
        same = lambda x, i: F.get(placed, i)["gram"] == x["gram"]
        at = F.transform(placed, lambda x, i: F.when(same(x, i - 1) | same(x, i + 1), x["at"]))
        return _let(F.sort_array(F.filter(at, lambda p: p.isNotNull())), covered)

    def count(grams: Column) -> Column:
        placed = F.sort_array(F.transform(grams, lambda g, i: F.struct(g.alias("gram"), i.alias("at"))))
        return F.when(F.size(F.array_distinct(grams)) == F.size(grams), F.lit(0)).otherwise(_let(placed, again))

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return _let(hashes, lambda h: _let(_grams(h, run), count))


def normalised_line(line: Column) -> Column:
    """A-Z in lower case, every digit as 0, runs of white space as one blank, none at the ends."""
    plain = F.translate(line, _UPPER + _DIGITS, _UPPER.lower() + "0" * 10)
    return F.trim(F.regexp_replace(plain, _SPACES, " "))


def _line_prints(lines: Column) -> Column:
    def one(line: Column) -> Column:
        n_words = F.length(line) - F.length(F.translate(line, " ", "")) + 1
        return F.struct(F.xxhash64(line).alias("line"), n_words.cast("long").alias("words"))

    return F.transform(lines, lambda x: _let(normalised_line(x), one))


def _measured(docs: DataFrame, id_col: str, text_col: str, host_col: str, keep_text: bool) -> DataFrame:
    """A stored row for each document: figures of its text, and hash and words of each of its lines."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.translate(x, SPACE, "") != "")

    def of_words(words: Column) -> Column:
        return F.struct(F.size(words).cast("long").alias("n_words"), repeated_words(words).cast("long").alias("n_repeat_words"))

    def of_lines(lines: Column) -> Column:
        return F.struct((F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"), _line_prints(lines).alias("lines"))

    rows = docs.select(F.col(id_col).alias("id"), F.col(host_col).alias("host"), F.col(text_col).cast("string").alias("text"))
    rows = rows.select(
        F.monotonically_increasing_id().alias("row"), "id", "host", F.xxhash64(text).alias("text_key"),
        F.length(F.translate(text, SPACE, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        _let(words_of(F.col("text")), of_words).alias("w"), _let(lines, of_lines).alias("l"), *(["text"] if keep_text else []),
    )
    return materialize(rows, "lines").select("*", "w.*", "l.*").drop("w", "l")


def frequent_lines(rows: DataFrame, most_docs: int) -> DataFrame:
    """``host, line, keeper`` of each line in more than ``most_docs`` different texts of its host; keeper is the least id."""
    each = rows.select("host", "text_key", "id", F.explode(F.array_distinct(F.col("lines.line"))).alias("line"))
    counted = each.groupBy("host", "line").agg(F.count_distinct("text_key").alias("n_docs"), F.min("id").alias("keeper"))
    return counted.where(F.col("n_docs") > most_docs).select("host", "line", "keeper")


def judge_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    most_docs: int = 10,
    least_words: int = 10,
    least_percent: int = 30,
    repeat_percent: int = 20,
    clean_text: bool = False,
    broadcast_rows: int = 100_000,
    salts: int = 32,
) -> DataFrame:
    """Per row: id, ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, n_left_words, kept``.

    ``base_failed``: fewer than ``least_words`` words, or over ``repeat_percent`` of the words in repeated runs of five.
    Of the others a document is kept if, without its frequent lines, it has ``least_words`` words
    and ``least_percent`` of its words left. Equal texts count as one document when a line's
    documents are counted, so that copies, which are another operator's work, make no line frequent; the
    document of least id keeps a frequent line, so that no text goes from the whole table.

    Null and empty texts have no words and fail; a null host is a host of its own; a null
    id keeps a line only if all ids with it are null; rows that repeat an id are judged each for itself. Other columns
    are ignored. With ``clean_text`` the text without its frequent lines comes along (null stays null). Frequent lines are
    broadcast up to ``broadcast_rows``; more are joined by host, line and one of ``salts`` numbers, which splits a common line.
    """
    rows = _measured(docs, id_col, text_col, host_col, clean_text)
    frequent = materialize(frequent_lines(rows, most_docs), "frequent-lines")
    each = rows.select("row", "id", "host", F.explode("lines").alias("l")).select("row", "id", "host", "l.*")
    renamed = frequent.select(F.col("host").alias("its_host"), F.col("line").alias("its_line"), "keeper")
    same = F.col("host").eqNullSafe(F.col("its_host")) & (F.col("line") == F.col("its_line"))
    if frequent.count() <= broadcast_rows:
        met = each.join(F.broadcast(renamed), same)
    else:
        salted = renamed.withColumn("its_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        met = each.withColumn("salt", F.pmod(F.col("row"), F.lit(salts)).cast("int")).join(salted, same & (F.col("salt") == F.col("its_salt")))
    lost = met.where(~F.col("id").eqNullSafe(F.col("keeper"))).groupBy("row").agg(
        F.sum("words").alias("lost"), *([F.collect_set("line").alias("gone")] if clean_text else [])
    )
    figures = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    judged = rows.select("row", "id", *figures, *(["text"] if clean_text else [])).join(lost, "row", "left")
    left = F.col("n_words") - F.coalesce(F.col("lost"), F.lit(0))
    failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > repeat_percent * F.col("n_words"))
    enough = (left >= least_words) & (100 * left >= least_percent * F.col("n_words"))
    out = [F.col("id").alias(id_col), *figures, failed.alias("base_failed"), left.alias("n_left_words"), (~failed & enough).alias("kept")]
    if clean_text:
        stays = lambda x: ~F.array_contains("gone", F.xxhash64(normalised_line(x))) | (F.translate(x, SPACE, "") == "")
        without = F.array_join(F.filter(F.split("text", "\n"), stays), "\n")
        out.append(F.when(F.col("gone").isNull(), F.col("text")).otherwise(without).alias("clean_text"))
    return judged.select(out)


def op12_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_lines(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP12_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text,
    list_filter(regexp_split_to_array(coalesce(text, ''), '{_SPACES}'), lambda x: x <> '') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
runs AS (
  SELECT r, p, count(*) OVER (PARTITION BY r, key) AS n
  FROM (SELECT r, p, array_to_string(w[p + 1 : p + 5], ' ') AS key FROM (SELECT r, w, unnest(range(greatest(len(w) - 4, 0))) AS p FROM d))),
rep AS (SELECT r, count(DISTINCT q) AS n FROM (SELECT r, unnest(range(p, p + 5)) AS q FROM runs WHERE n > 1) GROUP BY r),
lines AS (
  SELECT r, doc_id, source, text, trim(regexp_replace(translate(x, '{_UPPER}{_DIGITS}', '{_UPPER.lower()}0000000000'), '{_SPACES}', ' ', 'g'), ' ') AS line
  FROM (SELECT r, doc_id, source, text, unnest(l) AS x FROM d)),
often AS (SELECT source, line, min(doc_id) AS keeper FROM lines GROUP BY source, line HAVING count(DISTINCT text) > 10),
lost AS (
  SELECT r, sum(len(string_split(lines.line, ' '))) AS n FROM lines JOIN often ON lines.line = often.line AND lines.source IS NOT DISTINCT FROM often.source
  WHERE doc_id IS DISTINCT FROM keeper GROUP BY r),
f AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
    len(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
    coalesce(rep.n, 0)::BIGINT AS n_repeat_words, (len(w) - coalesce(lost.n, 0))::BIGINT AS n_left_words
  FROM d LEFT JOIN rep USING (r) LEFT JOIN lost USING (r))
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND n_left_words >= 10 AND 100 * n_left_words >= 30 * n_words AS kept
FROM f
"""
