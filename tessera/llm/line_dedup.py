"""Operator 9, line dedup by winnowing over line hashes [native].

A passage is a run of consecutive lines of at least ``min_words`` words; one long
line is a passage too. Lines without a word are gaps; two runs are equal if their lines
are and their gaps stand at the same places, however long. The windows are the
shortest passages from each line on. A gram is the shortest run of half as many
words. Of the grams inside a window the one with the smallest hash (the rightmost
of equal ones) is its fingerprint: a passage that occurs twice holds a window whole,
so both copies have that fingerprint at the same place, whatever stands around them.

Fingerprints that occur once end there. Around the others the match is extended
both ways: every window of theirs, and the same run with the following lines up to
the next window (or over a gap of lines without words), meets the first place of the same lines. So each line that lies in
a later copy of any passage is found, whichever earlier copy it agrees with, and no
pairs of copies are made.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged

MIN_WORDS = 10       # words of the shortest passage; a lone line of fewer stays
# Words are runs without white space; in scripts written without spaces each character is one.
UNSPACED = r"\x{0E00}-\x{0EFF}\x{1000}-\x{109F}\x{1780}-\x{17FF}\x{2E80}-\x{9FFF}\x{F900}-\x{FAFF}"
WORD = rf"[{UNSPACED}]|[^\x20\x09-\x0D{UNSPACED}]+"


def _words(line, most: int):
    """Words of a line, at most ``most``: a line that reaches it is read no further and its words are not taken out."""
    reaches = rf"^[\x20\x09-\x0D]*+(?:(?:[{UNSPACED}]|[^\x20\x09-\x0D{UNSPACED}]++)[\x20\x09-\x0D]*+){{{most}}}"
    return F.when(line.rlike(reaches), most).otherwise(F.size(F.regexp_extract_all(line, F.lit(WORD), F.lit(0))))


def _text_key(id_col, text_col):
    """Names a document: rows that agree in id and text are one document."""
    return F.unhex(F.md5(F.concat_ws("|", F.coalesce(id_col.cast("string"), F.lit("-")), text_col)))


def _reach(lines, n, i, words: int):
    """The last line of the shortest run from line ``i`` on with ``words`` words; null if the text ends before."""
    upto = F.sequence(i, F.least(i + words - 1, n - 1))            # each line has a word
    zero = F.struct(F.lit(0).alias("sum"), F.lit(-1).alias("last"))
    run = F.aggregate(upto, zero, lambda a, q: F.when(a["sum"] >= words, a).otherwise(
        F.struct((a["sum"] + lines[q]["words"]).alias("sum"), q.alias("last"))))
    return F.when(run["sum"] >= words, run["last"])


def _run_hash(lines, first, last):
    """Of the lines and the gaps between them."""
    return F.unhex(F.md5(F.array_join(F.transform(F.sequence(first, last), lambda q: F.concat(
        F.when(lines[q]["gap"] & (q > first), "|").otherwise(""), F.hex(lines[q]["hash"]))), "")))


def _fingerprints(docs: DataFrame, min_words: int) -> DataFrame:
    """``doc_id, key, print, runs``: the fingerprints with the runs ``(hash, first, last)`` that extend their matches.

    ``first`` and ``last`` are line numbers of the text.
    """
    gram = max(1, min_words // 2)
    all_lines = F.transform(F.split("text", "\n", -1), lambda x, i: F.struct(
        i.alias("at"), _words(x, min_words).alias("words"),         # sums of words are only compared with min_words or less
        F.unhex(F.md5(x)).alias("hash")))
    lines, n = F.col("lines"), F.col("n")
    at = docs.select("doc_id", "key", F.filter(all_lines, lambda x: x["words"] > 0).alias("lines"))
    at = at.withColumn("lines", F.transform("lines", lambda x, i: x.withField("gap", F.when(
        i > 0, x["at"] > lines[i - 1]["at"] + 1).otherwise(False))))
    at = at.withColumn("n", F.size("lines"))
    # null for a text without words: a filter here would reach the scan and compute the lines again for each line
    each = F.when(n > 0, F.sequence(F.lit(0), n - 1))
    at = (at.withColumn("ends", F.transform(each, lambda i: _reach(lines, n, i, min_words)))
          .withColumn("grams", F.transform(F.transform(each, lambda i: _reach(lines, n, i, gram)), lambda e, i: F.when(
              e.isNotNull(), F.struct(e.alias("last"), _run_hash(lines, i, e).alias("hash"))))))
    ends, grams = F.col("ends"), F.col("grams")
    least = lambda i, e: F.array_min(F.transform(
        F.filter(F.sequence(i, e), lambda q: grams[q]["last"] <= e),
        lambda q: F.struct(grams[q]["hash"].alias("hash"), (-q).alias("from_right"))))
    at = at.withColumn("picked", F.transform(ends, lambda e, i: F.when(e.isNotNull(), -least(i, e)["from_right"])))
    picked = F.col("picked")

    def runs(i):
        """The window from line i on, and it with more lines: those with which the lines after i are no passage, one after a gap."""
        end = ends[i]
        more = F.when(i + 1 < n, F.coalesce(ends[i + 1], n)).otherwise(n) - 1
        gap = F.when(end + 1 < n, F.when(lines[end + 1]["gap"], end + 1))
        return F.transform(F.sequence(end, F.greatest(end, more, gap)), lambda j: F.struct(
            _run_hash(lines, i, j).alias("hash"), lines[i]["at"].alias("first"), lines[j]["at"].alias("last")))

    def print_(pos):
        mine = F.filter(F.sequence(F.greatest(pos - min_words + 1, F.lit(0)), pos), lambda i: picked[i] == pos)
        return F.struct(grams[pos]["hash"].alias("print"), F.flatten(F.transform(mine, runs)).alias("runs"))

    return at.select("doc_id", "key", F.inline(F.transform(
        F.array_distinct(F.filter("picked", lambda p: p.isNotNull())), print_)))


def repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``key, cut``: per document with later copies of passages, the sorted line numbers (from 0) to delete.

    ``docs`` has ``doc_id, text, key``. Lines without a word go where they stand inside a run.
    """
    if min_words < 1:
        raise ValueError("a passage has at least one word")
    prints = staged(_fingerprints(docs, min_words), "line-prints")
    again = prints.groupBy("print").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("print")
    again = staged(again, "line-prints-again")   # so the joins below read plain exchanges, of which a hot one can be split
    runs = prints.join(again, "print").select("doc_id", "key", F.inline("runs"))
    order = F.struct(F.col("doc_id").isNull().alias("x"), F.col("doc_id").alias("id"), "key", F.col("first").alias("at"))
    firsts = (runs.groupBy("hash").agg(F.min(order).alias("o"), F.count(F.lit(1)).alias("n")).where("n > 1")
              .select("hash", F.col("o.key").alias("key0"), F.col("o.at").alias("first0")))
    firsts = staged(firsts, "line-runs")
    later = runs.join(firsts, "hash").where((F.col("key") != F.col("key0")) | (F.col("first") > F.col("first0")))
    return later.groupBy("key").agg(F.sort_array(F.array_distinct(F.flatten(F.transform(
        F.collect_set(F.struct("first", "last")), lambda r: F.sequence(r["first"], r["last"]))))).alias("cut"))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with the later copies of repeated passages deleted; two columns are added.

    A passage is a run of consecutive lines with at least ``min_words`` words, so a
    line of that many is one by itself and shorter lines go only as parts of a run.
    Every line of a run that occurs earlier goes, in the order of doc_id (null last),
    then position, and so do lines without a word inside it (the earlier copy has such lines there too, of any number). The first place of each line is always
    kept. Repeats inside one text count too, overlapping ones included: of a line
    repeated on and on its first place stays.

    ``n_lines`` and ``n_cut`` (integers) count a text's lines and those deleted;
    columns of these names in ``docs`` are replaced. Texts of fewer than ``min_words``
    words stay as they are. Rows that agree in id and text are one document:
    they get the same result and are no copies of each other. A null text stays
    null (0 lines); a text whose lines all go becomes empty. Other columns pass.
    """
    key = "__line_dedup_key"
    text = F.col(text_col)
    keyed = docs.withColumn(key, _text_key(F.col(id_col), F.coalesce(text, F.lit(""))))
    each = docs.where(text.isNotNull()).select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"),
                                               _text_key(F.col(id_col), text).alias("key"))
    cut = repeated_lines(each, min_words).select(F.col("key").alias(key), F.col("cut").alias("__line_dedup_cut"))
    lines = F.split(text, "\n", -1)
    lines = F.split(text, "\n", -1)
    gone = F.col("__line_dedup_cut")
    kept = F.array_join(F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone),
                                    lambda i: F.element_at(F.col("__line_dedup_lines"), i + 1)), "\n")
    out = keyed.join(cut, key, "left").withColumn("__line_dedup_lines", lines)
    return (out.withColumn("n_lines", F.when(text.isNull(), 0).otherwise(F.size(lines)))
            .withColumn("n_cut", F.coalesce(F.size(gone), F.lit(0)))
            .withColumn(text_col, F.when(gone.isNull(), text).otherwise(kept))
            .drop(key, "__line_dedup_cut", "__line_dedup_lines"))


# The rule by itself, without hashes, grams or windows' minima: runs are compared as text.
SQL = rf"""
WITH d AS (SELECT doc_id, text, md5(coalesce(doc_id::VARCHAR, '-') || '|' || text) AS key,
                  string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL),
l AS (SELECT doc_id, key, unnest(ls) AS line, generate_subscripts(ls, 1) - 1 AS i FROM d),
w AS (SELECT *, len(regexp_extract_all(line, '{WORD}')) AS words FROM l),
f AS (SELECT *, row_number() OVER x AS p, sum(words) OVER x AS upto, lag(words) OVER x AS before, i - lag(i) OVER x > 1 AS gap
      FROM w WHERE words > 0
      WINDOW x AS (PARTITION BY key ORDER BY i ROWS UNBOUNDED PRECEDING)),
-- the shortest passage from each line on, and it with more lines: while those after its first are no passage, and over a gap
r AS (SELECT a.doc_id, a.key, a.p, b.p AS q, a.i, b.i AS j FROM f a JOIN f b ON a.key = b.key AND b.p BETWEEN a.p AND a.p + {MIN_WORDS}
      WHERE b.upto - a.upto + a.words >= {MIN_WORDS}
        AND (b.upto - a.upto < {MIN_WORDS} OR b.upto - b.words - a.upto + a.words < {MIN_WORDS}
             OR b.gap AND b.p > a.p AND b.upto - b.words - b.before - a.upto + a.words < {MIN_WORDS})),
t AS (SELECT r.doc_id, r.key, r.i, r.j, string_agg(CASE WHEN f.gap AND f.p > r.p THEN chr(10) ELSE '' END || f.line, chr(10) ORDER BY f.p) AS run
      FROM r JOIN f ON f.key = r.key AND f.p BETWEEN r.p AND r.q GROUP BY ALL),
n AS (SELECT *, row_number() OVER (PARTITION BY run ORDER BY doc_id, key, i) AS rn FROM t),
c AS (SELECT DISTINCT key, unnest(range(i, j + 1)) AS i FROM n WHERE rn > 1),
k AS (SELECT l.key, string_agg(line, chr(10) ORDER BY l.i) FILTER (WHERE c.i IS NULL) AS text,
             count(*) AS n_lines, count(c.i) AS n_cut
      FROM l LEFT JOIN c ON l.key = c.key AND l.i = c.i GROUP BY l.key)
SELECT doc_id, coalesce(k.text, '') AS text, n_lines::INT AS n_lines, n_cut::INT AS n_cut FROM d JOIN k ON d.key = k.key
UNION ALL SELECT doc_id, NULL, 0, 0 FROM documents WHERE text IS NULL
"""
