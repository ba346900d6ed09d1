"""Line deduplication by a deletion-neighbourhood join, in DataFrame functions only.

A line goes if an equal line, or one within one edit (a character put in, left out or replaced), stands earlier: in a
text of smaller id, or before it in its own. Equal lines are found at any length, if they hold a word; of them only the
first takes part in what follows, and only if it is long, as short lines are often within one edit by chance.

Two lines of at most one edit share a *variant*: with the character at some place left out they are equal, or one of
them is the other with a character left out. The hashes of all variants are the keys of the join. The key of a replaced
character names its place as well, so lines of one key are all within one edit of each other, and each has to be
compared with the earliest only, never with every other.

Emitting every variant of every line would cost its length squared. Whatever the edit is, it lies in one of two halves
of the line, and the other half stays; so a line takes part only if it shares a half, at the place and length that
such an edit leaves, with another. Then the same holds for sixteenths. Only variants within a shared sixteenth are left
to emit. Each of the steps keeps every pair that is within one edit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm.common import WORD, documents, durable_table, probably_in

#: Lines of fewer characters go for equality only: short ones are often within one edit of each other by chance.
MIN_CHARS = 32
#: Lines of fewer characters, and shorter ones than MIN_CHARS without a word, are left alone.
EXACT_CHARS = 1
HALVES, PARTS = 2, 16
PLACE = ("d", "r", "p")


def _bound(length: Column, part: Column, parts: int) -> Column:
    return F.floor(length * part / parts).cast("int")


def _left(line: Column, n: Column) -> Column:
    return F.substring(line, F.lit(1), n)


def _right(line: Column, n: Column) -> Column:
    """The last n characters."""
    return F.when(n > 0, F.substring(line, F.char_length(line) - n + 1, n)).otherwise("")


def _part_key(line: Column, role: int, part: Column, parts: int) -> Column:
    """What stays of a line if one of its `parts` is cut out, with the length of the shorter line of a pair.

    role 0: this line is the shorter one, or both are equally long; role 1: it is the longer one by a character.
    """
    shorter = F.char_length(line) - role
    before = _bound(shorter, part, parts)
    behind = shorter - _bound(shorter, part + 1, parts)
    return F.xxhash64(shorter, part, _left(line, before), F.lit("\n"), _right(line, behind))


def _keys(rows: DataFrame, choices: Column) -> DataFrame:
    """A row for each of the choices, an array of (key, role, part)."""
    return rows.select(*[c for c in rows.columns if c != "choices"], F.inline(choices))


def _shared(rows: DataFrame) -> DataFrame:
    """Rows whose key a second line has, one of them in role 0."""
    keys = rows.groupBy("key").agg(F.count(F.lit(1)).alias("lines"), F.min("role").alias("least")).filter("lines > 1 AND least = 0")
    return rows.join(keys.select("key"), "key", "left_semi")


def _choice(line: Column, role: int, part: int, parts: int) -> Column:
    return F.struct(_part_key(line, role, F.lit(part), parts).alias("key"), F.lit(role).alias("role"), F.lit(part).alias("part"))


def _variants(line: Column, role: Column, part: Column) -> Column:
    """(kind, key) of every variant with the character left out in that sixteenth; kind 0: replaced, 1: the shorter
    line of a pair, 2: the longer one."""
    length = F.char_length(line)
    shorter = length - role
    lo, hi = _bound(shorter, part, PARTS), _bound(shorter, part + 1, PARTS)
    without = lambda i: F.concat(_left(line, i), _right(line, length - i - 1))
    replaced = F.when(hi > lo, F.transform(F.sequence(lo, F.greatest(lo, hi - 1)), lambda i: F.struct(F.lit(0).alias("kind"), F.xxhash64(F.lit(0), i, without(i)).alias("key"))))
    itself = F.array(F.struct(F.lit(1).alias("kind"), F.xxhash64(F.lit(1), line).alias("key")))
    longer = F.transform(F.sequence(lo, hi), lambda i: F.struct(F.lit(2).alias("kind"), F.xxhash64(F.lit(1), without(i)).alias("key")))
    return F.when(role == 0, F.concat(F.coalesce(replaced, F.array().cast("array<struct<kind:int,key:bigint>>")), itself)).otherwise(longer)


def _split(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Documents as arrays of lines. `d` and `r` tell rows apart: the id and a hash of the text."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    own = F.col(id_col).cast("long")
    others = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns) if c not in (id_col, text_col)]
    return docs.select(
        own.alias("doc_id"), F.coalesce(own, F.lit(-(1 << 63))).alias("d"), F.xxhash64(text).alias("r"), F.split(text, "\n").alias("lines"),
        F.struct(*others, F.lit(None).cast("int").alias("none")).alias("rest"),
    )


def _long_lines(texts: DataFrame, min_chars: int) -> DataFrame:
    return texts.select("d", "r", F.posexplode("lines").alias("p", "line")).filter(F.char_length("line") >= min_chars)


def _compared(line: Column, min_chars: int, exact_chars: int) -> Column:
    """Whether a line takes part, if only for equality."""
    return (F.char_length(line) >= min_chars) | ((F.char_length(line) >= exact_chars) & line.rlike(WORD))


def first_lines(texts: DataFrame, min_chars: int, exact_chars: int) -> DataFrame:
    """The first place of every distinct line, and the keys of its halves, null for lines that go for equality only.

    Equality is that of two 64-bit hashes.
    """
    line = F.col("line")
    keys = [F.when(F.char_length(line) >= min_chars, _part_key(line, role, F.lit(part), HALVES)).alias(f"k{role}{part}") for role in (0, 1) for part in range(HALVES)]
    lines = texts.select("d", "r", F.posexplode("lines").alias("p", "line")).filter(_compared(line, min_chars, exact_chars))
    hashed = lines.select(*PLACE, F.xxhash64("line").alias("h"), F.xxhash64(F.lit(1), "line").alias("g"), *keys)
    names = [f"k{role}{part}" for role in (0, 1) for part in range(HALVES)]
    first = hashed.groupBy("h", "g").agg(F.min(F.struct(*PLACE)).alias("at"), *[F.min(k).alias(k) for k in names])
    return first.select("at.*", *names)


def near_lines(texts: DataFrame, first: DataFrame, min_chars: int) -> DataFrame:
    """Places of first lines that have an earlier line within one edit."""
    halves = F.array(*[F.struct(F.col(f"k{role}{part}").alias("key"), F.lit(role).alias("role"), F.lit(part).alias("part")) for role in (0, 1) for part in range(HALVES)])
    half = _shared(_keys(first.filter("k00 IS NOT NULL").select(*PLACE, halves.alias("choices")), F.col("choices")))
    wanted = durable_table(half.groupBy(*PLACE).agg(F.collect_set(F.col("role") * HALVES + F.col("part")).alias("codes")), "half-shared")
    rows = probably_in(_long_lines(texts, min_chars), wanted, list(PLACE)).join(wanted, list(PLACE)).distinct()
    line = F.col("line")
    sixteenths = [
        F.when(F.array_contains("codes", F.lit(role * HALVES + part * HALVES // PARTS)), _choice(line, role, part, PARTS)) for role in (0, 1) for part in range(PARTS)
    ]
    parts = _shared(_keys(rows.select(*PLACE, "line", F.array_compact(F.array(*sixteenths)).alias("choices")), F.col("choices")))
    variants = parts.select(*PLACE, "line", F.inline(_variants(line, F.col("role"), F.col("part")))).distinct()
    # a replaced character: the earliest of the key. One left out: the shorter line, and the earliest of the longer ones
    entry = F.struct(*PLACE, "line")
    best = variants.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.when(F.col("kind") == 0, entry)).alias("same"), F.min(F.when(F.col("kind") == 1, entry)).alias("shorter"),
        F.min(F.when(F.col("kind") == 2, entry)).alias("longer"),
    ).filter("n > 1")
    partner = F.when(F.col("kind") == 0, F.col("same")).when(F.col("kind") == 1, F.col("longer")).otherwise(F.col("shorter"))
    pairs = variants.join(best, "key").select(*PLACE, "line", partner.alias("partner")).filter("partner IS NOT NULL")
    earlier = F.struct(*[F.col(f"partner.{c}") for c in PLACE]) < F.struct(*PLACE)
    return pairs.filter(earlier & (F.levenshtein("line", F.col("partner.line"), 1) >= 0)).select(*PLACE).distinct()


def kept_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, exact_chars: int = EXACT_CHARS,
) -> DataFrame:
    """`doc_id, lines, keep, rest`: the \\n-split lines of each row, and in ascending order the places of those that stay.

    A line of fewer than `min_chars` characters goes only if an equal one stands earlier; one of fewer than both
    `exact_chars` and `min_chars`, or of fewer than `min_chars` without a word, always stays. A null text is empty and has one empty line. A null id
    counts as the smallest; rows of equal id come in the order of a hash of their text, and rows of equal id and text
    are one document, whose copies keep the same lines. One row comes back per row.
    """
    texts = _split(docs, id_col, text_col)
    first = durable_table(first_lines(texts, min_chars, exact_chars), "first-lines")
    stay = first.select(*PLACE).join(near_lines(texts, first, min_chars), list(PLACE), "left_anti")
    stay = stay.groupBy("d", "r").agg(F.collect_list("p").alias("stay"))
    alone = F.array_compact(F.transform("lines", lambda x, i: F.when(~_compared(x, min_chars, exact_chars), i)))
    joined = texts.join(stay, ["d", "r"], "left")
    keep = F.array_sort(F.concat(alone, F.coalesce("stay", F.array().cast("array<int>"))))
    return joined.select("doc_id", "lines", keep.alias("keep"), "rest")


def _kept_text() -> Column:
    return F.array_join(F.transform("keep", lambda i: F.col("lines")[i]), "\n")


def remove_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, exact_chars: int = EXACT_CHARS,
) -> DataFrame:
    """`docs` with the texts made of the lines that stay. Every row and every other column stays, the id as long."""
    out = kept_lines(docs, id_col, text_col, min_chars, exact_chars)
    own = {id_col: F.col("doc_id"), text_col: _kept_text()}
    return out.select(*[own.get(c, F.col(f"rest.c{i}")).alias(c) for i, c in enumerate(docs.columns)])


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = kept_lines(documents(spark, sf_dir))
    lines, kept = F.size("lines").cast("long"), F.size("keep").cast("long")
    return out.select("doc_id", lines.alias("n_lines"), (lines - kept).alias("n_removed"), F.sha2(_kept_text(), 256).alias("kept_sha256"))


QUERIES = {"op7_line_dedup": op7_line_dedup}
_SPLIT = "string_split({}, '')"
ORACLES = {
    "op7_line_dedup": f"""
        WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
        line AS (SELECT doc_id, unnest(lines) AS s, generate_subscripts(lines, 1) AS p FROM split),
        firsts AS (SELECT s, length(s) AS n, min((doc_id, p)) AS place FROM line
                   WHERE length(s) >= {MIN_CHARS} OR regexp_matches(s, '[^ \\x09-\\x0D]') GROUP BY s),
        lengths AS (SELECT *, unnest([n, n - 1]) AS l FROM firsts WHERE n >= {MIN_CHARS}),
        half AS (SELECT *, unnest(['<' || substr(s, 1, l // 2), '>' || substr(s, n - l + l // 2 + 1)]) AS k FROM lengths),
        pair AS (SELECT DISTINCT a.s AS x, b.s AS y, a.n AS nx, b.n AS ny, b.place FROM half a JOIN half b ON a.l = b.l AND a.k = b.k AND a.place < b.place),
        near AS (
            SELECT DISTINCT place FROM pair
            WHERE nx = ny AND len(list_filter(list_zip({_SPLIT.format('x')}, {_SPLIT.format('y')}), lambda c: c[1] <> c[2])) <= 1
               OR nx = ny + 1 AND len(list_filter(range(nx), lambda i: substr(x, 1, i) || substr(x, i + 2) = y)) > 0
               OR ny = nx + 1 AND len(list_filter(range(ny), lambda i: substr(y, 1, i) || substr(y, i + 2) = x)) > 0),
        gone AS (SELECT doc_id, p FROM line JOIN firsts USING (s) WHERE (doc_id, p) <> place OR place IN (SELECT place FROM near))
        SELECT doc_id, count(*) AS n_lines, count(gone.p) AS n_removed,
               sha256(coalesce(string_agg(line.s, chr(10) ORDER BY line.p) FILTER (gone.p IS NULL), '')) AS kept_sha256
        FROM line LEFT JOIN gone USING (doc_id, p) GROUP BY doc_id"""
}
