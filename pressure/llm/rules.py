"""Quality rules: plain limits on text statistics, then robust multivariate outliers.

The statistics of every whole text are counted with built-in functions, row by row, no word is shuffled. Rows
that pass the plain limits make the vectors: logarithms of word length and of symbols, repeated lines and repeated
words per hundred words. Minimum-covariance-determinant estimates are made of them for each language and source, for each
language, and for all rows: from two starts, median and spread of each statistic and mean and covariance of
all, concentration steps keep the SHARE of rows nearest to the estimate and estimate again; of the two, the smaller
determinant stays. A row is rejected if its Mahalanobis distance, by the estimate of its language and source, or the next wider one
that has at least LEAST_ROWS rows, is beyond the chi-square quantile. With fewer rows in all, no row is rejected so.

Vectors are whole numbers of 1/UNIT, so all sums are exact and do not depend on the order of rows. The nearest rows are
found by counting distances in fine bins, with their moments: one pass over the vectors a step, a few hundred rows a group after it.
A spread below FLOORS is not told apart: a statistic that most rows lack would otherwise have none.

Null texts are empty and fail the plain limits, as do all short ones. Null languages and sources are groups of their own.
Repeated rows are judged one by one, alike. An empty table gives no rows. Other columns are not read, and a 64-bit hash stands for three words.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from math import exp, log

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pressure.sources.scratch import keep

# Characters between words, symbols, and the plain limits.
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
LEAST_WORDS, MOST_REPEATED = 50, 50

STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
# The vector, and below what spread its parts are not told apart: a tenth in length, three quarters of an e-fold in rates.
VECTOR = ("word_length", "symbols", "repeated_lines", "repeated_words")
FLOORS = (0.1, 0.75, 0.75, 0.75)
UNIT = 256
SHARE = (1, 2)
STEPS = 4
LEAST_ROWS = 10 * len(VECTOR)
CONFIDENCE = 0.9999
# Bins a doubling of (1 + squared distance).
BINS = 32
# Parts over which rows of one group are spread when they look up its estimate.
SALTS = 16
# From spread of the middle half to standard deviation, for a normal distribution.
NORMAL = 1.4826


def chi_square(x: float, degrees: int) -> float:
    """Distribution function, for an even number of degrees."""
    term, total = 1.0, 1.0
    for k in range(1, degrees // 2):
        term *= x / 2 / k
        total += term
    return 1 - exp(-x / 2) * total


def chi_square_quantile(p: float, degrees: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square(middle, degrees) < p else (low, middle)
    return low


SIZE = len(VECTOR)
CUTOFF = chi_square_quantile(CONFIDENCE, SIZE)
# The nearest part of normal rows has less covariance than all of them, by this factor.
CONSISTENT = SHARE[0] / SHARE[1] / chi_square(chi_square_quantile(SHARE[0] / SHARE[1], SIZE), SIZE + 2)

PAIRS = [(i, j) for i in range(SIZE) for j in range(i + 1)]
MOMENTS = [*[f"s{i}" for i in range(SIZE)], *[f"s{i}{j}" for i, j in PAIRS]]
ESTIMATE = [*[f"m{i}" for i in range(SIZE)], *[f"l{i}{j}" for i, j in PAIRS]]


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is worked out once."""
    return F.transform(F.array(value), body)[0]


def _neighbours(items: Column, job: Callable[[Column, Column], Column]) -> Column:
    """`job` of every item and the next."""
    fewer = F.greatest(F.size(items) - 1, F.lit(0))
    return F.zip_with(F.slice(items, F.lit(1), fewer), F.slice(items, F.lit(2), fewer), job)


def _covered(hashes: Column) -> Column:
    """Words in windows of three whose hash occurs again, from the hashes of all windows in order."""

    def at_places(places: Column) -> Column:
        steps = _neighbours(places, lambda a, b: F.least(b - a, F.lit(3)))
        return F.when(F.size(places) == 0, 0).otherwise(F.aggregate(steps, F.lit(3), lambda total, step: total + step))

    def of_sorted(windows: Column) -> Column:
        pairs = _neighbours(windows, lambda x, y: F.when(x["h"] == y["h"], F.array(x["at"], y["at"])).otherwise(F.array().cast("array<int>")))
        return _let(F.array_sort(F.array_distinct(F.flatten(pairs))), at_places)

    windows = F.array_sort(F.transform(hashes, lambda h, at: F.struct(h.alias("h"), at.alias("at"))))
    # Most texts repeat no window, and need no sort.
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(_let(windows, of_sorted))


def _of_words(words: Column) -> Column:
    windows = F.when(
        F.size(words) >= 3,
        F.transform(F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))),
    ).otherwise(F.array().cast("array<bigint>"))
    return F.struct(F.size(words).alias("n_words"), _let(windows, _covered).alias("n_repeat_words"))


def with_statistics(docs: DataFrame, keys: Sequence[str], text_column: str = "text") -> DataFrame:
    """The key columns, STATISTICS (longs) and base_failed of every row."""
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+", -1), lambda w: w != "")
    lines = F.filter(F.split(text, "\n", -1), lambda line: F.trim(line, F.lit(BLANKS)) != "")
    counted = docs.select(
        *keys,
        _let(words, _of_words).alias("_words"),
        F.length(F.regexp_replace(text, r"[\x20\x09-\x0D]+", "")).alias("word_chars"),
        (F.length(text) - F.length(F.regexp_replace(text, f"[{SYMBOLS}]+", ""))).alias("n_symbols"),
        _let(lines, lambda every: F.size(every) - F.size(F.array_distinct(every))).alias("n_dup_lines"),
    )
    counted = counted.select(*keys, "_words.n_words", "word_chars", "n_symbols", "n_dup_lines", "_words.n_repeat_words")
    counted = counted.select(*keys, *[F.col(c).cast("long").alias(c) for c in STATISTICS])
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return counted.withColumn("base_failed", failed)


def _vector() -> dict[str, Column]:
    """z0, z1 ...: whole numbers; null where the plain limits fail."""

    def rate(name: str) -> Column:
        return F.log(1 + 100 * F.col(name) / F.col("n_words"))

    parts = [F.log(F.col("word_chars") / F.col("n_words")), rate("n_symbols"), rate("n_dup_lines"), rate("n_repeat_words")]
    return {f"z{i}": F.when(~F.col("base_failed"), F.floor(part * UNIT + 0.5)).cast("long") for i, part in enumerate(parts)}


def _moments() -> list[Column]:
    first = [F.sum(f"z{i}").alias(f"s{i}") for i in range(SIZE)]
    return [*first, *[F.sum(F.col(f"z{i}") * F.col(f"z{j}")).alias(f"s{i}{j}") for i, j in PAIRS]]


def _with_root(df: DataFrame) -> DataFrame:
    """Adds the Cholesky root l00, l10, l11 ... of the covariance c00, c10, c11 ... with the floors."""
    for i, j in PAIRS:
        rest = F.col(f"c{i}{j}") + (F.lit(FLOORS[i] * FLOORS[i]) if i == j else F.lit(0.0))
        for k in range(j):
            rest = rest - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
        df = df.withColumn(f"l{i}{j}", F.sqrt(rest) if i == j else rest / F.col(f"l{j}{j}"))
    return df


def _from_moments(df: DataFrame, factor: float) -> DataFrame:
    """(group, start, ESTIMATE) of sums over n rows."""
    n = F.col("n").cast("double")
    means = {f"m{i}": F.col(f"s{i}") / n / UNIT for i in range(SIZE)}
    spread = {f"c{i}{j}": (F.col(f"s{i}{j}") / n / (UNIT * UNIT) - F.col(f"m{i}") * F.col(f"m{j}")) * factor for i, j in PAIRS}
    return _with_root(df.withColumns(means).withColumns(spread)).select("level", "key", "start", *ESTIMATE)


def squared_distance(prefix: str = "") -> Column:
    """Of the vector z0, z1 ... by the estimate whose columns have this prefix."""
    solved: list[Column] = []
    for i in range(SIZE):
        rest = F.col(f"z{i}") / UNIT - F.col(f"{prefix}m{i}")
        for k in range(i):
            rest = rest - F.col(f"{prefix}l{i}{k}") * solved[k]
        solved.append(rest / F.col(f"{prefix}l{i}{i}"))
    return reduce(lambda a, b: a + b, [y * y for y in solved])


def _levels(rows: DataFrame) -> DataFrame:
    """Each row once for its language and source, once for its language, once for all; a key is unambiguous JSON."""
    level = [F.struct(F.lit(i).alias("level"), F.col(f"key{i}").alias("key")) for i in range(3)]
    return rows.where(F.col("z0").isNotNull()).withColumn("_level", F.explode(F.array(*level))).select("*", "_level.*").drop("_level")


def _middle(df: DataFrame, value: str, name: str) -> DataFrame:
    """(level, key, part, name): the lower median of `value`, whose numbers n are counted."""
    by = Window.partitionBy("level", "key", "part")
    so_far = F.sum("n").over(by.orderBy(value))
    half = df.withColumns({"_upto": so_far, "_all": F.sum("n").over(by)}).where(2 * F.col("_upto") >= F.col("_all"))
    return half.groupBy("level", "key", "part").agg(F.min(value).alias(name))


def _starts(rows: DataFrame) -> DataFrame:
    """Estimates to start from: 0 median and spread of each part, 1 mean and covariance of all."""
    grouped = _levels(rows)
    sums = grouped.groupBy("level", "key").agg(F.count("*").alias("n"), *_moments()).where(F.col("n") >= LEAST_ROWS)
    sums = keep(sums, "moments")
    plain = _from_moments(sums.withColumn("start", F.lit(1)), 1.0)
    parts = F.explode(F.array(*[F.struct(F.lit(i).alias("part"), F.col(f"z{i}").alias("value")) for i in range(SIZE)]))
    counts = grouped.select("level", "key", parts.alias("_part")).groupBy("level", "key", "_part.part", "_part.value").agg(F.count("*").alias("n"))
    counts = keep(counts, "counts")
    on = ["level", "key", "part"]
    middle = _middle(counts, "value", "median")
    away = counts.join(middle, on).groupBy(*on, F.abs(F.col("value") - F.col("median")).alias("away")).agg(F.sum("n").alias("n"))
    robust = middle.join(_middle(away, "away", "spread"), on).groupBy("level", "key").pivot("part", list(range(SIZE)))
    robust = robust.agg(F.first("median").alias("m"), F.first("spread").alias("d"))
    scaled = {f"m{i}": F.col(f"{i}_m") / UNIT for i in range(SIZE)}
    for i, j in PAIRS:
        deviation = F.col(f"{i}_d") / UNIT * NORMAL
        scaled[f"c{i}{j}"] = deviation * deviation if i == j else F.lit(0.0)
    robust = _with_root(robust.withColumns(scaled)).withColumn("start", F.lit(0)).join(sums.select("level", "key"), ["level", "key"], "left_semi")
    return plain.unionByName(robust.select(*plain.columns))


def _spread(estimates: DataFrame) -> DataFrame:
    return estimates.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def _concentrate(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """The estimates of the SHARE of rows nearest to each estimate: whole bins up to the one that completes it."""
    group = ["level", "key", "start"]
    near = _levels(rows).join(_spread(estimates), ["level", "key", "salt"])
    near = near.withColumn("bin", F.floor(F.log2(1 + squared_distance()) * BINS))
    bins = near.groupBy(*group, "bin").agg(F.count("*").alias("n"), *_moments())
    by = Window.partitionBy(*group)
    taken = bins.withColumns({"_before": F.sum("n").over(by.orderBy("bin")) - F.col("n"), "_all": F.sum("n").over(by)})
    taken = taken.where(SHARE[1] * F.col("_before") < SHARE[0] * F.col("_all"))
    return _from_moments(taken.groupBy(*group).agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in MOMENTS]), CONSISTENT)


def estimates(rows: DataFrame, steps: int = STEPS) -> DataFrame:
    """(level, key, ESTIMATE): of each group the estimate with the smallest determinant."""
    found = keep(_starts(rows), "estimates")
    for _ in range(steps):
        found = keep(_concentrate(rows, found), "estimates")
    size = reduce(lambda a, b: a * b, [F.col(f"l{i}{i}") for i in range(SIZE)])
    return found.groupBy("level", "key").agg(F.min_by(F.struct(*ESTIMATE), F.struct(size, "start")).alias("best")).select("level", "key", "best.*")


def judge(docs: DataFrame, text_column: str = "text", language: str = "lang", source: str = "source", id_column: str = "doc_id") -> DataFrame:
    """Id, statistics, base_failed, kept, squared distance and the level it was taken at (0 language and source, 1 language, 2 all)."""
    named = docs.select(
        F.col(id_column), F.col(text_column).alias("_text"),
        F.to_json(F.array(F.col(language).cast("string"), F.col(source).cast("string"))).alias("key0"),
        F.to_json(F.array(F.col(language).cast("string"))).alias("key1"), F.lit("").alias("key2"),
    )
    rows = with_statistics(named, [id_column, "key0", "key1", "key2"], "_text").withColumns(_vector())
    rows = keep(rows.withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int")), "statistics")
    fitted = keep(estimates(rows), "estimates")
    judged = rows
    for level in range(3):
        own = _spread(fitted.where(F.col("level") == level).drop("level"))
        own = own.withColumnsRenamed({c: f"e{level}_{c}" for c in ESTIMATE} | {"key": f"key{level}"})
        judged = judged.join(own, [f"key{level}", "salt"], "left")
    distances = [squared_distance(f"e{level}_") for level in range(3)]
    distance = F.coalesce(*distances)
    at = F.coalesce(*[F.when(d.isNotNull(), level) for level, d in enumerate(distances)])
    kept = ~F.col("base_failed") & F.coalesce(distance <= CUTOFF, F.lit(True))
    return judged.select(id_column, *STATISTICS, "base_failed", kept.alias("kept"), distance.alias("distance"), at.alias("level"))


def rule_report(docs: DataFrame) -> DataFrame:
    """doc_id, STATISTICS, base_failed and kept of every document."""
    return judge(docs).drop("distance", "level")


def _distance_sql(z: str, e: str) -> str:
    """The same distance in SQL: forward substitution, its steps nested."""
    solved: list[str] = []
    for i in range(SIZE):
        rest = f"{z}.z{i} / {UNIT}.0::DOUBLE - {e}.m{i}"
        for k in range(i):
            rest += f" - {e}.l{i}{k} * {solved[k]}"
        solved.append(f"(({rest}) / {e}.l{i}{i})")
    return " + ".join(f"{y} * {y}" for y in solved)


def _root_sql(source: str, columns: str) -> str:
    """SELECT of `columns` and the root of c00, c10 ... of a table, one nested query an entry."""
    for i, j in PAIRS:
        rest = f"c{i}{j}" + (f" + {FLOORS[i] * FLOORS[i]!r}::DOUBLE" if i == j else " + 0.0::DOUBLE")
        rest += "".join(f" - l{i}{k} * l{j}{k}" for k in range(j))
        source = f"(SELECT *, {f'sqrt({rest})' if i == j else f'({rest}) / l{j}{j}'} AS l{i}{j} FROM {source})"
    return f"SELECT {columns}, {', '.join(ESTIMATE)} FROM {source}"


def _moments_sql(factor: float) -> str:
    """Adds m0 ..., then c00 ... to a table of sums; for use as `FROM (... {} ...)`."""
    means = ", ".join(f"s{i}::DOUBLE / n::DOUBLE / {UNIT}.0::DOUBLE AS m{i}" for i in range(SIZE))
    spread = ", ".join(f"(s{i}{j}::DOUBLE / n::DOUBLE / {UNIT * UNIT}.0::DOUBLE - m{i} * m{j}) * {factor!r}::DOUBLE AS c{i}{j}" for i, j in PAIRS)
    return f"(SELECT *, {spread} FROM (SELECT *, {means} FROM {{}}))"


def oracle_sql() -> str:
    blank = r"[\x20\x09-\x0D]"
    sums = ", ".join([f"sum(z{i}) AS s{i}" for i in range(SIZE)] + [f"sum(z{i} * z{j}) AS s{i}{j}" for i, j in PAIRS])
    rate = "floor(ln(1 + 100 * {}::DOUBLE / n_words) * {} + 0.5)::BIGINT"
    parts = " UNION ALL ".join(f"SELECT level, k1, k2, {i} AS part, z{i} AS value FROM leveled" for i in range(SIZE))
    middle = "SELECT level, k1, k2, part, min(value) AS {0} FROM (SELECT *, sum(n) OVER (PARTITION BY level, k1, k2, part ORDER BY value) AS upto, sum(n) OVER (PARTITION BY level, k1, k2, part) AS everything FROM {1}) WHERE 2 * upto >= everything GROUP BY ALL"
    robust = ", ".join([f"max(median) FILTER (part = {i})::DOUBLE / {UNIT}.0::DOUBLE AS m{i}" for i in range(SIZE)] + [
        f"(max(spread) FILTER (part = {i})::DOUBLE / {UNIT}.0::DOUBLE * {NORMAL}::DOUBLE) * (max(spread) FILTER (part = {i})::DOUBLE / {UNIT}.0::DOUBLE * {NORMAL}::DOUBLE) AS c{i}{i}" if i == j else f"0.0::DOUBLE AS c{i}{j}"
        for i, j in PAIRS
    ])
    steps = []
    for t in range(1, STEPS + 1):
        taken = f"SELECT level, k1, k2, start, sum(n) AS n, {', '.join(f'sum({c}) AS {c}' for c in MOMENTS)} FROM (SELECT *, sum(n) OVER (PARTITION BY level, k1, k2, start ORDER BY bin) - n AS before, sum(n) OVER (PARTITION BY level, k1, k2, start) AS everything FROM bins{t}) WHERE {SHARE[1]} * before < {SHARE[0]} * everything GROUP BY ALL"
        steps.append(
            f"bins{t} AS MATERIALIZED (SELECT level, k1, k2, start, bin, count(*) AS n, {sums} FROM (SELECT v.*, e.start, floor(log2(1 + {_distance_sql('v', 'e')}) * {BINS}) AS bin FROM leveled v JOIN est{t - 1} e USING (level, k1, k2)) GROUP BY ALL),\n"
            f"est{t} AS MATERIALIZED ({_root_sql(_moments_sql(CONSISTENT).format(f'({taken})'), 'level, k1, k2, start')})"
        )
    size = " * ".join(f"l{i}{i}" for i in range(SIZE))
    joins = "".join(
        f" LEFT JOIN best e{i} ON e{i}.level = {i} AND e{i}.k1 = {'d.k1' if i < 2 else chr(39) * 2} AND e{i}.k2 = {'d.k2' if i == 0 else chr(39) * 2}" for i in range(3)
    )
    return f"""
WITH texts AS (SELECT row_number() OVER () AS r, doc_id, coalesce('v' || lang, 'null') AS k1, coalesce('v' || source, 'null') AS k2, coalesce(text, '') AS t FROM documents),
words AS (SELECT *, list_filter(regexp_split_to_array(t, '{blank}+'), lambda x: x <> '') AS w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM texts),
windows AS (SELECT r, unnest(range(1, len(w) - 1)) AS i, unnest(w[:len(w) - 2]) AS x, unnest(w[2:len(w) - 1]) AS y, unnest(w[3:]) AS z FROM words WHERE len(w) >= 3),
again AS (SELECT r, i FROM windows JOIN (SELECT r, x, y, z FROM windows GROUP BY ALL HAVING count(*) > 1) USING (r, x, y, z)),
covered AS (SELECT r, count(DISTINCT i + k) AS n FROM again, (SELECT unnest([0, 1, 2]) AS k) GROUP BY r),
stats AS (
  SELECT r, doc_id, k1, k2, len(w)::BIGINT AS n_words, length(regexp_replace(t, '{blank}+', '', 'g'))::BIGINT AS word_chars,
    (length(t) - length(translate(t, '{SYMBOLS}', '')))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words
  FROM words LEFT JOIN covered c USING (r)),
judged AS (SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed FROM stats),
vectors AS MATERIALIZED (
  SELECT *, floor(ln(word_chars::DOUBLE / n_words) * {UNIT} + 0.5)::BIGINT AS z0, {rate.format('n_symbols', UNIT)} AS z1,
    {rate.format('n_dup_lines', UNIT)} AS z2, {rate.format('n_repeat_words', UNIT)} AS z3
  FROM judged WHERE NOT base_failed),
leveled AS MATERIALIZED (
  SELECT 0 AS level, * FROM vectors UNION ALL SELECT 1, * REPLACE ('' AS k2) FROM vectors UNION ALL SELECT 2, * REPLACE ('' AS k1, '' AS k2) FROM vectors),
moments AS (SELECT level, k1, k2, count(*) AS n, {sums} FROM leveled GROUP BY ALL HAVING count(*) >= {LEAST_ROWS}),
counts AS (SELECT level, k1, k2, part, value, count(*) AS n FROM ({parts}) GROUP BY ALL),
middle AS ({middle.format('median', 'counts')}),
away AS (SELECT level, k1, k2, part, abs(value - median) AS value, sum(n) AS n FROM counts JOIN middle USING (level, k1, k2, part) GROUP BY ALL),
around AS ({middle.format('spread', 'away')}),
robust AS (SELECT level, k1, k2, {robust} FROM middle JOIN around USING (level, k1, k2, part) SEMI JOIN moments USING (level, k1, k2) GROUP BY level, k1, k2),
est0 AS MATERIALIZED (
  {_root_sql('robust', 'level, k1, k2, 0 AS start')}
  UNION ALL {_root_sql(_moments_sql(1.0).format('moments'), 'level, k1, k2, 1 AS start')}),
{(',' + chr(10)).join(steps)},
best AS (SELECT * FROM est{STEPS} QUALIFY row_number() OVER (PARTITION BY level, k1, k2 ORDER BY {size}, start) = 1),
distance AS (
  SELECT d.r, coalesce({_distance_sql('d', 'e0')}, {_distance_sql('d', 'e1')}, {_distance_sql('d', 'e2')}) AS d2 FROM vectors d{joins})
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND coalesce(d2 <= {CUTOFF!r}::DOUBLE, true) AS kept
FROM judged LEFT JOIN distance USING (r)
"""
