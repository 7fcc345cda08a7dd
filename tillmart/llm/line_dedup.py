"""Near-duplicate lines over all documents, with DataFrame functions only.

Two lines are linked if a few edits (signs put in, taken out or replaced) turn one into the
other: one edit, or `edits` if the shorter line has at least `long_chars` signs. A line that e
edits may change is split into e + 1 segments of equal length, so one of them is untouched: the
first one before which there are as many edits as segments. So segment j stands in the other
line moved by s signs, with at most j edits before it and e - j after it. Every line is indexed
under its length and its segments; it is probed, for its own length and lengths up to e less,
under all its substrings that may be such a segment.

Keys that few lines share give pairs of lines. The lines of a key with more are told apart
further: what lies before and after the shared segment may differ by fewer edits, and is split
and probed by the same rule, until few lines share a key or nothing is left to split. Then one line
stands for all that can be made equal by the edits left, whatever their last signs are, and is paired
with each of them. Pairs are verified by edit distance: Spark's own for short lines; long ones lose
their common start and end, which changes no distance, and are compared bit-parallel in a band of
diagonals. Equal lines are one class from the start.

Texts of lines are shuffled once, to fetch those of classes that share a key; the final join shuffles
the documents. No join of as many rows as there are lines is broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmart.llm.common import most_frequent, passing_tables, written
from tillmart.llm.graph import components

# Edits between two lines of which the shorter one has LONG_CHARS signs; others may differ by one.
MAX_EDITS = 2
LONG_CHARS = 64

# Shorter lines recur by chance; they are left alone.
MIN_CHARS = 32

# Lines of one key that are compared in pairs; with more of them, a key is split first.
FEW = 8

# Classes with the most copies, of which keys are worked out for one line only.
MOST_COPIED = 50_000

# Longer lines are compared in a band of diagonals; Spark's own distance reads them whole for each sign.
PLAIN_CHARS = 1000
END_CHARS = 64

# Texts are cut by sign in this encoding of four bytes each, where a cut needs no scan.
SIGN_BYTES = 4

# Parts of a line that may still differ: where they start in the line, their length there and in
# the indexed line, and by how many edits.
PARTS = "array<struct<at: int, own: int, target: int, edits: int>>"


def _signs(line: Column) -> Column:
    return F.encode(line, "UTF-32")


def _cut(signs: Column, start: Column, count: Column) -> Column:
    """`count` signs after the first `start` ones."""
    return F.substring(signs, start * SIGN_BYTES + 1, count * SIGN_BYTES)


def _moves(edits: int) -> list[tuple[int, int]]:
    """Segments and by how many signs they may be moved."""
    return [(j, s) for j in range(edits + 1) for s in range(-j, j + 1)]


def _bounds(target: Column, edits: int, j: int) -> tuple[Column, Column]:
    """Where segment j starts and ends."""
    at = [F.floor(target * k / (edits + 1)).cast("int") for k in (j, j + 1)]
    return at[0], at[1]


def _sides(at: Column, own: Column, target: Column, edits: int, j: int, s: int) -> Column:
    """What lies before and after a segment."""
    start, end = _bounds(target, edits, j)
    before = F.struct(
        at.alias("at"), (start + s).alias("own"), start.alias("target"), F.lit(j).alias("edits")
    )
    after = F.struct(
        (at + end + s).alias("at"),
        (own - end - s).alias("own"),
        (target - end).alias("target"),
        F.lit(edits - j).alias("edits"),
    )
    return F.array(before, after).cast(PARTS)


def _open(sides: Column) -> Column:
    """Those that are long enough to be split."""
    return F.filter(sides, lambda part: (part["edits"] > 0) & (part["target"] > part["edits"]))


def _sure(sides: Column) -> Column:
    """Whether those that are not open can be made equal by their edits, whatever they hold."""
    return F.forall(
        sides, lambda part: (part["target"] > part["edits"]) | (part["own"] <= part["edits"])
    )


def _left(sides: Column) -> list[Column]:
    """parts, those that are open, and sure."""
    return [_open(sides).alias("parts"), _sure(sides).alias("sure")]


def _first_moves(edits: int) -> list[tuple[int, int, int, int]]:
    """Edits, signs more than the indexed line, segment and move of each key of a line."""
    found = []
    for most in sorted({1, edits}):
        for more in range(most + 1):
            for j, s in _moves(most):
                if abs(more - s) <= most - j:
                    found.append((most, more, j, s))
    return found


def _allowed(length: Column, edits: int, long_chars: int) -> Column:
    return F.when(length >= long_chars, edits).otherwise(1)


def _first_rows(lines: DataFrame, edits: int, min_chars: int, long_chars: int) -> DataFrame:
    """cls, number and key: every line's keys by their places in `_first_moves`."""
    length, signs = F.col("length"), F.col("signs")
    moves = _first_moves(edits)
    # Columns, so that each is worked out once and the code for the keys stays small.
    cuts = {
        f"cut_{most}_{more}_{k}": F.floor((length - more) * k / (most + 1)).cast("int")
        for most, more, _, _ in moves
        for k in range(1, most + 1)
    }
    given = lines.withColumn("signs", _signs(F.col("line"))).withColumn("length", F.length("line"))
    given = given.withColumns(cuts)
    keys = []
    for most, more, j, s in moves:
        target = length - more
        ends = [F.lit(0), *[F.col(f"cut_{most}_{more}_{k}") for k in range(1, most + 1)], target]
        key = F.xxhash64(F.lit(j), target, _cut(signs, ends[j] + s, ends[j + 1] - ends[j]))
        fits = (target >= min_chars) & (_allowed(target, edits, long_chars) == most)
        keys.append(F.when(fits, key))
    rows = given.select("cls", F.array(*keys).alias("keys"))
    # For an inner explode Spark would filter by the array, and so work it out twice.
    return rows.select("cls", F.posexplode_outer("keys").alias("number", "key")).filter("key IS NOT NULL")


def _first_parts(number: Column, length: Column, edits: int) -> list[Column]:
    """parts, which the key of this place in `_first_moves` leaves open, and sure."""
    sides = F.array().cast(PARTS)
    for place, (most, more, j, s) in enumerate(_first_moves(edits)):
        found = _sides(F.lit(0), length, length - more, most, j, s)
        sides = F.when(number == place, found).otherwise(sides)
    return _left(sides)


def _split(rows: DataFrame, edits: int) -> DataFrame:
    """cls, key, indexed, parts and sure, with the first open part of each row split.

    `rows` has the line's signs beside them. A row becomes one for each segment of the part and
    each place where it may stand.
    """
    part = F.get("parts", F.lit(0))
    more = part["own"] - part["target"]
    others = F.slice("parts", 2, F.greatest(F.size("parts") - 1, F.lit(0)))
    moved = []
    for most in range(1, edits + 1):
        for j, s in _moves(most):
            start, end = _bounds(part["target"], most, j)
            fits = (part["edits"] == most) & (F.abs(more - s) <= most - j)
            fits &= (start + s >= 0) & (end + s <= part["own"])
            segment = _cut(F.col("signs"), part["at"] + start + s, end - start)
            sides = _sides(part["at"], part["own"], part["target"], most, j, s)
            found = F.struct(
                F.xxhash64("key", F.lit(j), segment).alias("key"),
                (F.col("indexed") & F.lit(s == 0)).alias("indexed"),
                F.concat(others, _open(sides)).alias("parts"),
                (F.col("sure") & _sure(sides)).alias("sure"),
            )
            moved.append(F.when(fits, found))
    fitting = F.filter(F.array(*moved), lambda to: to.isNotNull())
    taken = rows.select("cls", F.explode_outer(fitting).alias("to")).filter("to IS NOT NULL")
    return taken.select("cls", "to.key", "to.indexed", "to.parts", "to.sure")


def _common(a: Column, b: Column, from_end: bool) -> Column:
    """How many signs two strings have in common at their start or end, by halving steps."""
    most = F.least(F.length(a), F.length(b))

    def same(known: Column, step: Column) -> Column:
        if from_end:
            cut = [F.substring(x, F.length(x) - known - step + 1, step) for x in (a, b)]
        else:
            cut = [F.substring(x, known + 1, step) for x in (a, b)]
        return (known + step <= most) & (cut[0] == cut[1])

    steps = F.array(*[F.lit(1 << n) for n in range(30, -1, -1)])
    return F.aggregate(
        F.filter(steps, lambda step: step <= most),
        F.lit(0),
        lambda known, step: F.when(same(known, step), known + step).otherwise(known),
    )


def differing(pairs: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Takes the common start, then the common end off two columns; the distance stays.

    Each step is written, so that later filters are not pushed into it and its expressions
    are not repeated in them.
    """
    for from_end in (False, True):
        shared = pairs.withColumn("_shared", _common(F.col(a), F.col(b), from_end))
        shared = written(shared, "common-signs")
        cut = {}
        for name in (a, b):
            kept = F.length(name) - F.col("_shared")
            start = F.lit(1) if from_end else F.col("_shared") + 1
            cut[name] = F.substring(F.col(name), start, kept)
        pairs = shared.withColumns(cut).drop("_shared")
    return written(pairs, "differing-lines")


def within_edits(a: Column, b: Column, edits: int = MAX_EDITS) -> Column:
    """Whether at most `edits` single-sign edits turn a into b.

    For each number of edits a word of bits holds the diagonals, from -edits to edits, on which
    that many edits reach the signs of b read so far. Reading one sign moves all diagonals at
    once: matches stay, a replaced sign stays with one edit more, and a sign only in b or only
    in a moves one diagonal down or up.
    """
    width = 2 * edits + 1
    mask = F.lit((1 << width) - 1)
    signs_a, signs_b = (F.regexp_extract_all(x, F.lit("(?s)."), F.lit(0)) for x in (a, b))
    words, bits = [], 1 << edits
    for _ in range(edits + 1):
        words.append(bits)
        bits |= (bits << 1) & ((1 << width) - 1)
    names = [f"e{n}" for n in range(edits + 1)]
    start = F.struct(
        F.lit(0).alias("at"), signs_a.alias("a"), *[F.lit(w).alias(n) for n, w in zip(names, words)]
    )

    def step(state: Column, sign: Column) -> Column:
        matches = F.lit(0)
        for diagonal in range(width):
            same = F.get(state["a"], state["at"] + F.lit(diagonal - edits)) == sign
            matches = matches.bitwiseOR(F.when(same, F.lit(1 << diagonal)).otherwise(F.lit(0)))
        moved: list[Column] = []
        for n, name in enumerate(names):
            reached = state[name].bitwiseAND(matches)
            if n:
                before = state[names[n - 1]]
                reached = reached.bitwiseOR(before).bitwiseOR(F.shiftright(before, 1))
                reached = reached.bitwiseOR(F.shiftleft(moved[-1], 1))
            moved.append(reached.bitwiseAND(mask))
        fields = [x.alias(n) for x, n in zip(moved, names)]
        following = F.struct((state["at"] + 1).alias("at"), state["a"].alias("a"), *fields)
        return F.when(state[names[-1]] == 0, state).otherwise(following)

    difference = F.length(a) - F.length(b)
    end = F.lit(0)
    for diagonal in range(width):
        end = F.when(difference == diagonal - edits, 1 << diagonal).otherwise(end)
    return F.aggregate(signs_b, start, step, lambda state: state[names[-1]].bitwiseAND(end) > 0)


def _lines(documents: DataFrame, min_chars: int) -> DataFrame:
    """doc_id, number, line and its class, for all lines long enough."""
    exploded = documents.select("doc_id", F.posexplode(F.split("text", "\n")).alias("number", "line"))
    return exploded.filter(F.length("line") >= min_chars).withColumn("cls", F.xxhash64("line"))


def _without_copies(lines: DataFrame, classes: DataFrame) -> DataFrame:
    """The lines, of the MOST_COPIED most copied classes only the first one.

    Other classes keep their copies: to know them all, every line would be shuffled.
    """
    copied = most_frequent(classes.filter("copies > 1"), "copies", MOST_COPIED)
    first = F.broadcast(copied.select(F.col("cls").alias("_copied"), "first"))
    place = F.struct("doc_id", "number")
    marked = lines.join(first, F.col("cls") == F.col("_copied"), "left")
    stays = F.col("_copied").isNull() | place.eqNullSafe(F.col("first"))
    return marked.filter(stays).select("cls", "line")


def _links(lines: DataFrame, edits: int, min_chars: int, long_chars: int) -> DataFrame:
    """lo, hi: pairs of classes whose lines, cls and line, are within the edits allowed.

    Of classes that are linked by pairs, some pairs may be left out.
    """
    own = [n for n, (_, more, _, s) in enumerate(_first_moves(edits)) if not more and not s]
    # Keys are shuffled once, both to be counted and to be joined with the counts.
    rows = _first_rows(lines, edits, min_chars, long_chars).repartition("key")
    indexed = F.col("number").isin(own).alias("indexed")
    met = _met(rows.select("cls", "key", indexed)).select("key")
    rows = written(rows.join(met.hint("shuffle_hash"), "key").distinct(), "shared-keys")
    asked = rows.select("cls").distinct()
    lines = written(lines.join(asked.hint("merge"), "cls").dropDuplicates(["cls"]), "line-texts")
    length = lines.select("cls", F.length("line").alias("length"))
    opened = rows.join(length, "cls").select(
        "cls", "key", indexed, *_first_parts(F.col("number"), F.col("length"), edits)
    )
    found = _told_apart(opened, lines, edits)
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionByName(more)
    a = lines.select(F.col("cls").alias("lo"), F.col("line").alias("a"))
    b = lines.select(F.col("cls").alias("hi"), F.col("line").alias("b"))
    both = pairs.distinct().join(a, "lo").join(b, "hi")
    most = _allowed(F.least(F.length("a"), F.length("b")), edits, long_chars)
    both = written(both.withColumn("most", most), "line-pairs")
    return _verified(both, edits).select("lo", "hi")


def _verified(pairs: DataFrame, edits: int) -> DataFrame:
    """The pairs whose columns a and b are at most `most` edits apart, 1 or `edits`."""

    def near(within) -> Column:
        one = within(1)
        return F.when(F.col("most") == 1, one).otherwise(within(edits)) if edits > 1 else one

    def near_ends(most: int) -> Column:
        # As many first signs of each line, or last ones, are at most twice as far apart.
        first, last = ([end(F.col(x), F.lit(END_CHARS)) for x in "ab"] for end in (F.left, F.right))
        return (F.levenshtein(*first, 2 * most) >= 0) & (F.levenshtein(*last, 2 * most) >= 0)

    pairs = pairs.filter(near(near_ends))
    longest = F.greatest(F.length("a"), F.length("b"))
    short = pairs.filter(longest <= PLAIN_CHARS)
    found = short.filter(near(lambda most: F.levenshtein("a", "b", most) >= 0))
    long = pairs.filter(longest > PLAIN_CHARS)
    if long.isEmpty():
        return found
    banded = near(lambda most: within_edits(F.col("a"), F.col("b"), most))
    return found.unionByName(differing(long).filter(banded))


def _met(rows: DataFrame) -> DataFrame:
    """key and count of all keys by which an indexed line meets another one."""
    met = rows.groupBy("key").agg(
        F.count(F.lit(1)).alias("count"),
        F.max("indexed").alias("indexed"),
        F.min("cls").alias("lo"),
        F.max("cls").alias("hi"),
    )
    return met.filter("count > 1 AND indexed AND lo <> hi").select("key", "count")


def _told_apart(rows: DataFrame, lines: DataFrame, edits: int) -> list[DataFrame]:
    """Pairs (lo, hi) of classes that still share a key when keys of many are split.

    Each round splits an open part of every row whose key has more than FEW rows. Open parts get
    shorter with every round, so there are as many rounds as the logarithm of the longest line.
    """
    found = []
    rows = written(rows, "line-rows")
    while True:
        rows = written(rows.join(_met(rows), "key"), "line-rows")
        open_ = F.size("parts") > 0
        found.append(_pairs(rows.filter(F.col("count") <= FEW)))
        found.append(_stars(rows.filter((F.col("count") > FEW) & ~open_)))
        rest = rows.filter((F.col("count") > FEW) & open_)
        if rest.isEmpty():
            return found
        signs = lines.select("cls", _signs(F.col("line")).alias("signs"))
        rows = written(_split(rest.join(signs, "cls"), edits).distinct(), "split-rows")


def _ordered(pairs: DataFrame) -> DataFrame:
    """lo and hi of the pairs of different classes x and y."""
    return pairs.filter("x <> y").select(F.least("x", "y").alias("lo"), F.greatest("x", "y").alias("hi"))


def _pairs(rows: DataFrame) -> DataFrame:
    """Every indexed line of a key with every other line of it."""
    a = rows.filter("indexed").select("key", F.col("cls").alias("x"))
    b = rows.select("key", F.col("cls").alias("y"))
    return _ordered(a.join(b, "key"))


def _stars(rows: DataFrame) -> DataFrame:
    """Pairs that connect the lines of keys of which no part is open.

    A sure line is linked with every indexed one, and indexed ones are sure: one of them stands for
    all. Other lines meet every indexed one, of which there are as many as ways to write the few
    signs that are left.
    """
    indexed = rows.filter("indexed")
    center = indexed.groupBy("key").agg(F.min("cls").alias("x"))
    sure = rows.filter("sure").select("key", F.col("cls").alias("y"))
    stars = sure.join(center, "key")
    a = indexed.select("key", F.col("cls").alias("x")).distinct()
    b = rows.filter("NOT sure").select("key", F.col("cls").alias("y"))
    return _ordered(stars).unionByName(_ordered(a.join(b, "key")))


def repeated_lines(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = MIN_CHARS,
    edits: int = MAX_EDITS,
    long_chars: int = LONG_CHARS,
) -> DataFrame:
    """doc_id and dropped, the numbers (from 0) of its lines that repeat an earlier one.

    Lines of at least `min_chars` signs form components by links, of one edit, or of `edits` if
    the shorter line has at least `long_chars` signs; of each component the line
    with the smallest id, then number, stays, and all others are dropped. Only ids with dropped
    lines are returned. A null id counts as the smallest. Rows with the same id drop the same
    numbers.
    """
    chosen = documents.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    ).filter("text IS NOT NULL")
    with passing_tables(documents.sparkSession):
        repeated = _repeated(chosen, min_chars, edits, long_chars)
        return written(repeated, "repeated-lines", keep=True)


def _repeated(chosen: DataFrame, min_chars: int, edits: int, long_chars: int) -> DataFrame:
    lines = _lines(chosen, min_chars)
    classes = lines.groupBy("cls").agg(
        F.min(F.struct("doc_id", "number")).alias("first"), F.count(F.lit(1)).alias("copies")
    )
    classes = written(classes, "line-classes")
    links = _links(_without_copies(lines, classes), edits, min_chars, long_chars)
    links = links.select(F.col("lo").alias("a"), F.col("hi").alias("b"))
    groups = components(links).withColumnRenamed("node", "cls")
    grouped = groups.join(classes.select("cls", "first").hint("merge"), "cls")
    earliest = grouped.groupBy("component").agg(F.min("first").alias("kept"))
    in_group = groups.join(earliest.hint("merge"), "component").select("cls", "kept")
    decided = (
        classes.join(in_group.hint("merge"), "cls", "left")
        .filter("copies > 1 OR kept IS NOT NULL")
        .select("cls", F.coalesce("kept", "first").alias("kept"))
    )
    place = F.struct("doc_id", "number")
    repeats = lines.select("doc_id", "number", "cls").join(decided.hint("merge"), "cls")
    repeats = repeats.filter(~place.eqNullSafe(F.col("kept")))
    return repeats.groupBy("doc_id").agg(F.collect_set("number").alias("dropped"))


ADDED = ["n_lines", "n_dropped"]


def dedup_lines(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = MIN_CHARS,
    edits: int = MAX_EDITS,
    long_chars: int = LONG_CHARS,
) -> DataFrame:
    """The documents without their repeated lines, and n_lines and n_dropped for each.

    All rows and columns stay; `repeated_lines` says which lines go, in the text column. Lines
    end at a line feed. A null text stays null and has no lines; an empty text has one, which is
    too short to go. Columns named as the two added are replaced. An empty table gives no rows.
    """
    repeated = repeated_lines(documents, id_col, text_col, min_chars, edits, long_chars)
    given = documents.drop(*ADDED)
    repeated = repeated.select(F.col("doc_id").alias("_repeated_id"), F.col("dropped").alias("_dropped"))
    # The lists of dropped lines grow with the documents, so they are never broadcast.
    joined = given.join(
        repeated.hint("merge"), given[id_col].cast("long").eqNullSafe(F.col("_repeated_id")), "left"
    )
    joined = joined.withColumn("_lines", F.split(F.col(text_col), "\n"))
    lines, size = F.col("_lines"), F.size("_lines")
    gone = F.sort_array(F.filter("_dropped", lambda number: number < size))
    # The lines between one dropped line and the next.
    runs = F.zip_with(
        F.concat(F.array(F.lit(-1)), gone),
        F.concat(gone, F.array(size)),
        lambda last, following: F.slice(lines, last + 2, following - last - 1),
    )
    kept = F.when(F.col("_dropped").isNull(), F.col(text_col)).otherwise(
        F.array_join(F.flatten(runs), "\n")
    )
    counts = {
        "n_lines": F.when(F.col(text_col).isNull(), 0).otherwise(size).cast("long"),
        "n_dropped": F.when(F.col("_dropped").isNull(), 0).otherwise(F.size(gone)).cast("long"),
    }
    with_counts = joined.withColumns(counts).withColumn(text_col, kept)
    return with_counts.select(*given.columns, *ADDED)


# The result of `op3_line_dedup`: lines with a third (or half) in common, up to two signs apart,
# are compared place by place; two edits are one at the first sign that differs and another one.
SQL_TEXT = """
    WITH RECURSIVE lines AS (
      SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
             unnest(range(len(string_split(text, chr(10))))) AS number
      FROM documents WHERE text IS NOT NULL),
    classes AS (
      SELECT line, length(line) AS n, CASE WHEN length(line) >= 64 THEN 2 ELSE 1 END AS e,
             row_number() OVER () AS cls, min({'doc_id': doc_id, 'number': number}) AS place
      FROM lines WHERE length(line) >= 32 GROUP BY line),
    segments AS (
      SELECT cls, n, e, j, j * n // (e + 1) AS p, (j + 1) * n // (e + 1) - j * n // (e + 1) AS size, line
      FROM classes, (SELECT unnest(range(3)) AS j) WHERE j <= e),
    targets AS (
      SELECT cls, n, n - more AS t, CASE WHEN n - more >= 64 THEN 2 ELSE 1 END AS e, line
      FROM classes, (SELECT unnest(range(3)) AS more)),
    probes AS (
      SELECT cls, t AS n, j,
             substr(line, j * t // (e + 1) + 1 + move, (j + 1) * t // (e + 1) - j * t // (e + 1)) AS part
      FROM targets, (SELECT unnest(range(3)) AS j), (SELECT unnest(range(-2, 3)) AS move)
      WHERE t >= 32 AND n - t <= e AND j <= e AND abs(move) <= e AND j * t // (e + 1) + move >= 0),
    pairs AS (
      SELECT DISTINCT s.cls AS a, q.cls AS b FROM segments s
      JOIN probes q ON q.n = s.n AND q.j = s.j AND q.part = substr(s.line, s.p + 1, s.size)
      WHERE s.cls <> q.cls),
    told AS (
      SELECT a, b, x.line AS x, y.line AS y, x.e AS e,
             list_min(list_filter(range(y.n), lambda k: substr(x.line, k + 1, 1) <> substr(y.line, k + 1, 1))) AS p
      FROM pairs JOIN classes x ON x.cls = a JOIN classes y ON y.cls = b
      WHERE x.n <= y.n AND levenshtein(x.line, y.line) <= 8),
    one_left AS (
      SELECT a, b, x AS u, y AS v FROM told
      UNION ALL SELECT a, b, substr(x, p + 2), substr(y, p + 2) FROM told WHERE e = 2
      UNION ALL SELECT a, b, substr(x, p + 1), substr(y, p + 2) FROM told WHERE e = 2
      UNION ALL SELECT a, b, substr(x, p + 2), substr(y, p + 1) FROM told WHERE e = 2),
    ordered AS (
      SELECT a, b, CASE WHEN length(u) <= length(v) THEN u ELSE v END AS x,
             CASE WHEN length(u) <= length(v) THEN v ELSE u END AS y, greatest(length(u), length(v)) AS m
      FROM one_left WHERE abs(length(u) - length(v)) <= 1),
    near AS (
      SELECT DISTINCT a, b FROM ordered WHERE x = y OR len(list_filter(range(m), lambda k:
        left(x, k) = left(y, k) AND right(x, m - k - 1) = right(y, m - k - 1))) > 0),
    links AS (SELECT a, b FROM near UNION SELECT b, a FROM near),
    reach AS (
      SELECT cls AS a, cls AS b FROM classes
      UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
    kept AS (
      SELECT reach.a AS cls, min(c.place) AS place
      FROM reach JOIN classes c ON c.cls = reach.b GROUP BY reach.a),
    decided AS (
      SELECT l.doc_id, l.number, l.line,
             coalesce(k.place <> {'doc_id': l.doc_id, 'number': l.number}, false) AS dropped
      FROM lines l LEFT JOIN classes c ON c.line = l.line LEFT JOIN kept k ON k.cls = c.cls)
    SELECT d.doc_id, count(x.doc_id) AS n_lines, count(*) FILTER (x.dropped) AS n_dropped,
           CASE WHEN d.text IS NOT NULL THEN
             coalesce(string_agg(x.line, chr(10) ORDER BY x.number) FILTER (NOT x.dropped), '') END AS text
    FROM documents d LEFT JOIN decided x ON x.doc_id = d.doc_id
    GROUP BY d.doc_id, d.text"""
