"""Line-first cleaning: rules judge every line, failing lines go, and documents that lose too much text are rejected.

Line rules, each on a line with at least one word:

* punctuation: it must end in a terminal mark (closing quotes and brackets aside) or have one after every 25th word on
  average, and in a line of 8 words or more no more than half of the words may have one;
* navigation: at most a tenth as many separators and symbols as words;
* boilerplate: in a line of at most 30 words, none of the fixed phrases of licences, cookie notices and site furniture;
  a longer line is prose that may mention them.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the rules.
SYMBOLS = "#*$%&|<>"
SEPARATORS = "»›•·"
TERMINAL = ".!?…:;"
CLOSING = "\"')]”’»"
PHRASES = ("all rights reserved", "accept cookies", "cookie policy", "enable javascript", "javascript is disabled",
           "licensed under the", "lorem ipsum", "powered by", "privacy policy", "sign up for", "skip to content",
           "subscribe to our", "terms of service", "terms of use", "this work is licensed under")
MIN_WORDS = 50
MAX_REPEATED = 50
MAX_LOST = 50
MANY_MARKS = 8
PROSE_WORDS = 25
PHRASE_WORDS = 30
#: Texts that a worker holds results of at once.
ROWS = 250

_PHRASES = re.compile("|".join(map(re.escape, PHRASES)))
_BLANKS = " \t\n\x0b\x0c\r"
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lost_words", "lost_lines")


def line_fails(line: str) -> tuple[str | None, int]:
    """The first rule that the line fails, if any, and its number of words."""
    words = line.encode().split()
    n = len(words)
    if not n:
        return None, 0
    bare = line.strip(_BLANKS).rstrip(CLOSING)
    marks = sum(w[-1:] in b".!?:;" for w in words)
    if bare[-1:] not in tuple(TERMINAL) and marks * PROSE_WORDS < n:
        return "punctuation", n
    if n >= MANY_MARKS and 2 * marks > n:
        return "punctuation", n
    if 10 * sum(line.count(c) for c in SYMBOLS + SEPARATORS) > n:
        return "navigation", n
    if n <= PHRASE_WORDS and _PHRASES.search(line.lower()):
        return "boilerplate", n
    return None, n


def repeated_words(words: list) -> int:
    """Words inside three-word windows that the text has twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    counts, covered, reach = Counter(windows), 0, 0
    for n, window in enumerate(windows):
        if counts[window] > 1:
            covered += n + 3 - max(reach, n)
            reach = n + 3
    return covered


def judge(text: str | None, max_lost: int = MAX_LOST) -> tuple:
    """The figures of STATS, base_failed, kept, and the text without its failing lines."""
    text = text or ""
    words = text.encode().split()
    n, seen, kept_lines = len(words), set(), []
    dup = lost = lost_lines = 0
    for line in text.split("\n"):
        rule, size = line_fails(line)
        if size:
            dup += line in seen
            seen.add(line)
        if rule:
            lost += size
            lost_lines += 1
        else:
            kept_lines.append(line)
    repeats = repeated_words(words)
    failed = n < MIN_WORDS or 100 * repeats > MAX_REPEATED * n
    return (n, len(text) - sum(map(text.count, _BLANKS)), sum(map(text.count, SYMBOLS)), dup, repeats, lost, lost_lines,
            failed, not failed and 100 * lost <= max_lost * n, "\n".join(kept_lines))


def line_clean(docs: DataFrame, text_col: str = "text", max_lost: int = MAX_LOST, cleaned: bool = True) -> DataFrame:
    """``docs`` with the figures of STATS, base_failed, kept and, on demand, ``cleaned``: the text of the passing lines.

    A null or blank text has no words and fails the base rules. Rows are judged one by one, repeated ones alike, so an
    empty table gives none; columns of ``docs`` with the name of a result are replaced by it."""
    made = [T.StructField(c, T.LongType()) for c in STATS] + [T.StructField(c, T.BooleanType()) for c in ("base_failed", "kept")]
    made += [T.StructField("cleaned", T.StringType())] * cleaned
    names = [f.name for f in made]
    rest = [c for c in docs.columns if c not in names]
    schema = T.StructType([docs.schema[c] for c in rest] + made)
    kinds = [pa.int64()] * len(STATS) + [pa.bool_()] * 2 + [pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(at, ROWS) for whole in batches for at in range(0, whole.num_rows, ROWS)):
            got = [judge(t, max_lost) for t in batch.column(len(rest)).to_pylist()]
            columns = list(zip(*got))
            yield pa.RecordBatch.from_arrays(batch.columns[:-1] + [pa.array(c, k) for c, k in zip(columns[:len(made)], kinds)], names=schema.names)

    own = [F.col(f"`{c}`") for c in rest]
    return docs.select(*own, F.col(f"`{text_col}`").cast("string").alias("judged_text")).mapInArrow(run, schema)


def _sql() -> str:
    word = r"[^\x20\x09-\x0D]+"
    count = lambda pattern, of: f"len(regexp_extract_all({of}, '{pattern}'))"
    words, ends = count(word, "l"), r"[.!?:;]([\x20\x09-\x0D]|$)"
    symbols = r"[#*$%&|<>]"
    fails = f"""((NOT regexp_matches(rtrim(rtrim(l, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '"'')]”’»'), '[.!?…:;]$')
          AND {PROSE_WORDS} * {count(ends, "l")} < {words})
      OR ({words} >= {MANY_MARKS} AND 2 * {count(ends, "l")} > {words})
      OR 10 * {count("[#*$%&|<>»›•·]", "l")} > {words}
      OR ({words} <= {PHRASE_WORDS} AND regexp_matches(lower(l), '{"|".join(PHRASES)}')))"""
    return f"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, regexp_extract_all(text, '{word}') AS ws FROM t),
p AS (SELECT r, unnest(range(1, len(ws) - 1)) AS i, unnest(list_transform(range(1, len(ws) - 1),
        lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) AS g FROM w WHERE len(ws) > 2),
c AS (SELECT r, count(DISTINCT k) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS k
        FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS m FROM p) WHERE m > 1) GROUP BY r),
l AS (SELECT r, l, row_number() OVER (PARTITION BY r, l) AS nth, {words} AS n
      FROM (SELECT r, unnest(string_split(text, chr(10))) AS l FROM t)),
d AS (SELECT r, count(*) FILTER (WHERE nth > 1) AS dup, coalesce(sum(n) FILTER (WHERE {fails}), 0) AS lost FROM l WHERE n > 0 GROUP BY r),
a AS (SELECT doc_id, len(ws) AS n_words, length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g')) AS word_chars,
        {count(symbols, "text")} AS n_symbols, coalesce(dup, 0) AS n_dup_lines,
        coalesce(n, 0) AS n_repeat_words, coalesce(lost, 0) AS lost_words
      FROM t JOIN w USING (r) LEFT JOIN c USING (r) LEFT JOIN d USING (r)),
b AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED} * n_words AS base_failed FROM a)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND 100 * lost_words <= {MAX_LOST} * n_words AS kept, CAST(lost_words AS BIGINT) AS lost_words FROM b"""


JUDGED_SQL = _sql()
