"""Line-first quality rules, as columns only.

Every line is judged on its own: symbols and shouting (punctuation rule), menu separators and
bare short lines (navigation rule), and notices of web pages (boilerplate rule). Lines that
fail are removed; a document goes if more than `MAX_LOST_PERCENT` of its word characters were
in them. Before that, a document goes if it has fewer than `MIN_WORDS` words or if over
`MAX_REPEAT_PERCENT` of its words lie in five-word windows that it holds twice or more.

Cases: NULL and empty texts have no words and are rejected; a text of any length is one row,
worked on by sorting its windows (no pairs); repeated rows are judged alike; empty tables give
empty tables; other columns are kept, those with the names of the outputs are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The words and symbols of the contract.
WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 5

# Rules of a line; percentages are of the line's words.
MAX_SYMBOLS_PERCENT = 30
MAX_SHOUTS_PERCENT = 30
MAX_BARS_PERCENT = 20
SHORT_LINE_WORDS = 3
NOTICE_LINE_WORDS = 30
SHOUT = r"[!?]{2,}"
BAR = r"[|»›•]"
TERMINAL = r"[.!?:;…。！？\"'”’)\]][\x20\x09-\x0D]*$"
NOTICE = (
    r"(?i)(all rights reserved|accept (all )?cookies|uses cookies|cookie policy|privacy policy"
    r"|terms of (use|service)|enable javascript|lorem ipsum|subscribe to our newsletter|sign in to continue)"
)

# Rules of a document.
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
MAX_LOST_PERCENT = 50

INNER = ["_lines", "_worded", "_words", "_windows", "_sorted", "_places"]
OUTPUT = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
          "n_removed_lines", "lost_chars", "clean_text", "kept"]


def word_chars(text: Column) -> Column:
    return F.length(F.regexp_replace(text, r"[\x20\x09-\x0D]+", ""))


def line_fails(line: Column) -> Column:
    """Whether a line is removed; lines without a word stay."""
    words = F.regexp_count(line, F.lit(WORD))
    percent = lambda pattern: 100 * F.regexp_count(line, F.lit(pattern))
    punctuation = (percent(SYMBOLS) > MAX_SYMBOLS_PERCENT * words) | (percent(SHOUT) > MAX_SHOUTS_PERCENT * words)
    navigation = (percent(BAR) > MAX_BARS_PERCENT * words) | (
        (words < SHORT_LINE_WORDS) & ~line.rlike(TERMINAL))
    boilerplate = (words <= NOTICE_LINE_WORDS) & line.rlike(NOTICE)
    return (words > 0) & (punctuation | navigation | boilerplate)


def repeated_places(df: DataFrame) -> DataFrame:
    """Add the starts of the windows that a document holds twice or more, in order."""
    word = lambda i: F.get("_words", i)
    n = F.size("_words")
    windows = F.when(
        n >= WINDOW,
        F.transform(F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(*[word(i + k) for k in range(WINDOW)])))
    df = df.withColumn("_windows", windows)
    twice = F.size(F.array_distinct("_windows")) < F.size("_windows")
    df = df.withColumn("_sorted", F.when(
        twice, F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    at = lambda j: F.get("_sorted", j)
    same = lambda j: (at(j)["h"] == at(j - 1)["h"]) | (at(j)["h"] == at(j + 1)["h"])
    found = F.transform(
        F.filter(F.sequence(F.lit(0), F.size("_sorted") - 1), lambda j: F.coalesce(same(j), F.lit(False))),
        lambda j: at(j)["i"])
    return df.withColumn("_places", F.when(F.col("_sorted").isNotNull(), F.sort_array(found)))


def covered(places: Column) -> Column:
    """Words in windows that start at the given places, each counted once."""
    start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("total"))
    step = lambda a, x: F.struct(
        x.alias("last"), (a["total"] + F.least(F.lit(WINDOW), x - a["last"])).alias("total"))
    return F.coalesce(F.aggregate(places, start, step)["total"], F.lit(0))


def apply_rules(docs: DataFrame) -> DataFrame:
    """Add the counts, the cleaned text and the verdict `kept`."""
    df = docs.select(*[c for c in docs.columns if c not in OUTPUT and c not in INNER])
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    df = df.withColumn("_lines", F.split(text, "\n", -1))
    df = df.withColumn("_words", F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1)))
    df = df.withColumn("_worded", F.filter("_lines", lambda x: x.rlike(WORD)))
    df = repeated_places(df)
    df = df.withColumn("clean_text", F.array_join(F.filter("_lines", lambda x: ~line_fails(x)), "\n"))
    df = df.withColumns({
        "n_words": F.size("_words").cast("long"),
        "word_chars": word_chars(text).cast("long"),
        "n_symbols": F.regexp_count(text, F.lit(SYMBOLS)).cast("long"),
        "n_dup_lines": (F.size("_worded") - F.size(F.array_distinct("_worded"))).cast("long"),
        "n_repeat_words": covered(F.col("_places")).cast("long"),
        "n_removed_lines": (F.size("_lines") - F.size(F.split("clean_text", "\n", -1))).cast("long"),
    })
    df = df.withColumn("lost_chars", F.col("word_chars") - word_chars(F.col("clean_text")).cast("long"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    df = df.withColumn("base_failed", failed)
    kept = ~F.col("base_failed") & (100 * F.col("lost_chars") <= MAX_LOST_PERCENT * F.col("word_chars"))
    return df.withColumn("kept", kept).drop(*INNER)


def keep(judged: DataFrame) -> DataFrame:
    """The documents with the verdict `kept`. A filter would be pushed below the projections,
    which then compute every column anew for each use; a generator is not."""
    times = F.array_repeat(F.lit(True), F.col("kept").cast("int"))
    return judged.select("*", F.explode(times).alias("_once")).drop("_once")


# The same in DuckDB, for the checks.
SQL = r"""
with d as (
  select doc_id, coalesce(text, '') as text, string_split(coalesce(text, ''), chr(10)) as lines,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words
  from documents),
l as (
  select doc_id, unnest(lines) as line, generate_subscripts(lines, 1) as place from d),
m as (
  select *, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) as w from l),
j as (
  select doc_id, line, place, w,
    row_number() over (partition by doc_id, line order by place) as nth,
    w > 0 and (
      100 * len(regexp_extract_all(line, '[#*$%&|<>]')) > 30 * w
      or 100 * len(regexp_extract_all(line, '[!?]{2,}')) > 30 * w
      or 100 * len(regexp_extract_all(line, '[|»›•]')) > 20 * w
      or (w < 3 and not regexp_matches(line, '[.!?:;…。！？"''”’)\]][\x20\x09-\x0D]*$'))
      or (w <= 30 and regexp_matches(line, '(?i)(all rights reserved|accept (all )?cookies|uses cookies|cookie policy|privacy policy|terms of (use|service)|enable javascript|lorem ipsum|subscribe to our newsletter|sign in to continue)'))
    ) as fails
  from m),
byline as (
  select doc_id, count(*) filter (w > 0 and nth > 1) as n_dup_lines,
    coalesce(sum(length(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g'))) filter (fails), 0) as lost
  from j group by doc_id),
win as (
  select doc_id, p, hash(words[p:p+4]) as h from (
    select doc_id, words, unnest(range(1, len(words) - 3)) as p from d where len(words) >= 5)),
twice as (
  select doc_id, p from (select *, count(*) over (partition by doc_id, h) as n from win) where n > 1),
rep as (
  select doc_id, sum(least(5, p - coalesce(prev, p - 5))) as n_repeat_words
  from (select *, lag(p) over (partition by doc_id order by p) as prev from twice) group by doc_id),
b as (
  select doc_id, cast(len(words) as bigint) as n_words,
    cast(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) as bigint) as word_chars,
    cast(len(regexp_extract_all(text, '[#*$%&|<>]')) as bigint) as n_symbols,
    cast(n_dup_lines as bigint) as n_dup_lines,
    cast(coalesce(n_repeat_words, 0) as bigint) as n_repeat_words, lost
  from d join byline using (doc_id) left join rep using (doc_id)),
f as (
  select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed from b)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and 100 * lost <= 50 * word_chars as kept
from f
"""
