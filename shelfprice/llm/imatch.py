"""Document fingerprints by I-Match. DataFrame functions only.

1. Terms are the runs of ASCII letters (made lower case), digits and non-ASCII characters.
   A term's document frequency is counted over all documents; the lexicon holds the terms
   whose inverse document frequency lies in a band: those that at least one document in
   ``RARE`` holds, and at most one in ``COMMON``. So it doesn't grow with the corpus: it has
   RARE times the mean number of distinct terms of a document at most. It is broadcast up
   to ``MOST`` terms and joined by an exchange beyond that. For each term it has a code: 40
   bits of the term's digest, and its place in the random draws below.
2. A document's distinct terms that are in the lexicon are kept, sorted by their codes.
3. Signature 0 is the hash of the sorted codes. Each of ``SEEDS`` random draws gives further
   lexicon subsets, each a random half of the one before it: signature (level, draw) is the
   hash of the sorted codes that are in the draw's subset of that level, and empty if none
   are. Of a document without any term of the lexicon, signature 0 is the hash of all its
   sorted distinct terms, and the others are empty.

The fingerprint is all signatures, joined by dots. Documents that differ in a few terms agree
in all subsets without those terms. If two texts have a share j of their terms in common, a
draw's signatures agree in log2(1 / (1 - j)) levels on average (subsets larger than that hold
a term that differs, smaller ones hold no term at all). So their likeness is 1 if signature 0
is equal, else 1 - 2^-m (rounded to nine places), m being the agreeing non-empty levels,
averaged over the draws.

Texts are split where they lie. What is exchanged are partial counts for the lexicon and, by
``signatures``, the codes of each row (none where rows already lie by its ``key``).

Defined results: a null text counts as empty; texts without terms have equal fingerprints.
Repeated rows each get the same fingerprint. Other columns are ignored. An empty table gives
an empty one. A text of any length is one row with one array of its distinct terms.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, join_spread, landed, table
from .components import components

RARE, COMMON = 1000, 10
SEEDS, LEVELS = 6, 11
MOST = 1 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BREAK = r"[\x00-/:-@\[-`{-\x7f]+"


def terms(text: Column) -> Column:
    """The distinct terms of a text."""
    return F.array_remove(F.array_distinct(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), BREAK)), "")


def code(term: Column) -> Column:
    """40 bits of the term's digest, then four bits a draw: the last level whose subset has
    the term, from the number of leading zeros of 12 more bits of the digest."""
    digest = F.md5(term.cast("binary"))

    def number(first: int, digits: int) -> Column:
        return F.conv(F.substring(digest, first, digits), 16, 10).cast("long")
    out = F.shiftleft(number(1, 10), 24)
    for s in range(SEEDS):
        level = F.least(F.lit(12) - F.length(F.bin(number(11 + 3 * s, 3))), F.lit(LEVELS))
        out = out.bitwiseOR(F.shiftleft(level.cast("long"), 4 * s))
    return out


def lexicon(docs: DataFrame, text: str = "text", rare: int = RARE, common: int = COMMON) -> DataFrame:
    """(term, n, code): the terms of the band and the number of documents that hold each."""
    n = docs.count()
    return (docs.select(F.explode(terms(F.col(text))).alias("term")).groupBy("term").agg(F.count("*").alias("n"))
            .where((F.col("n") * rare >= n) & (F.col("n") * common <= n)).withColumn("code", code(F.col("term"))))


def signatures(rows: DataFrame, key: list[str], texts: dict[str, str], known: DataFrame, notes: list[str] = ()) -> DataFrame:
    """For each row of ``rows``, which ``key`` tells apart, its key, the array of signatures
    of each of ``texts`` (out: column), and the strings ``notes``. ``known`` is a landed
    lexicon."""
    words = known.select("term", "code")
    words = F.broadcast(words) if words.count() <= MOST else words
    rows = rows.withColumns({f"_w{k}": terms(F.col(c)) for k, c in enumerate(texts.values())})
    n, every = len(texts), [F.substring(F.md5(F.array_join(F.array_sort(f"_w{k}"), " ").cast("binary")), 1, 16)
                            for k in range(len(texts))]
    held = [F.col(f"_w{k}") for k in range(n)] + [F.array(c) for c in [*every, *[F.col(c) for c in notes]]]
    items = (rows.select(*key, F.explode(F.array(*[F.struct(F.lit(k).alias("k"), a.alias("a")) for k, a in enumerate(held)])).alias("x"))
             .select(*key, "x.k", F.explode("x.a").alias("term")).join(words, "term", "left").where(f"code is not null or k >= {n}"))
    df = items.groupBy(*key).agg(
        *[F.sort_array(F.collect_list(F.when((F.col("k") == k), F.col("code")))).alias(f"_c{k}") for k in range(n)],
        *[F.max(F.when(F.col("k") == n + k, F.col("term"))).alias(f"_e{k}") for k in range(n)],
        *[F.max(F.when(F.col("k") == 2 * n + k, F.col("term"))).alias(c) for k, c in enumerate(notes)])

    def hashed(c: str) -> Column:
        return F.when(F.size(c) > 0, F.substring(F.md5(F.array_join(F.col(c).cast("array<string>"), " ").cast("binary")), 1, 16))
    for k in range(n):
        df = df.withColumn(f"_s{k}", F.array(F.coalesce(hashed(f"_c{k}"), f"_e{k}")))

    def in_half(s: int, level: int) -> Callable[[Column], Column]:
        return lambda x: F.shiftright(x, 4 * s).bitwiseAND(F.lit(15)) >= level
    halves = {f"_c{k}_{s}": f"_c{k}" for k in range(n) for s in range(SEEDS)}
    for level in range(1, LEVELS + 1):
        # from each subset its half, then the signatures of the halves
        df = df.withColumns({c: F.filter(before, in_half(int(c[-1]), level)) for c, before in halves.items()})
        halves = {c: c for c in halves}
        df = df.withColumns({f"_s{k}": F.concat(f"_s{k}", F.array(*[F.coalesce(hashed(f"_c{k}_{s}"), F.lit("")) for s in range(SEEDS)]))
                             for k in range(n)})
    return df.select(*key, *[F.col(f"_s{k}").alias(out) for k, out in enumerate(texts)], *notes)


def likeness(a: Column, b: Column) -> Column:
    """Of two arrays of signatures, 0 to 1."""
    agree = F.size(F.filter(F.zip_with(a, b, lambda x, y: (x == y) & (x != "")), lambda x: x))
    return F.when(a[0] == b[0], 1.0).otherwise(F.round(1.0 - F.pow(F.lit(2.0), -agree.cast("double") / SEEDS), 9))


def fingerprints(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, signatures, fingerprint), one row per input row."""
    rows = df.select(F.col(id_col).alias("_id"), F.col(text).alias("_text"), F.monotonically_increasing_id().alias("_r"))
    made = signatures(rows, ["_r", "_id"], {"signatures": "_text"}, landed(lexicon(df, text), "lexicon"))
    return made.select(F.col("_id").alias(id_col), "signatures", F.array_join("signatures", ".").alias("fingerprint"))


def duplicate_classes(df: DataFrame, id_col: str = "doc_id", text: str = "text", level: int = 1) -> DataFrame:
    """(id, class_id) for each id of ``df``: I-Match's classes. Documents with an equal
    signature of a draw's largest subsets (levels 0 to ``level``) are linked, and class_id is
    the smallest id that links lead to. Copies are linked to the first of them only. Empty
    signatures link nothing, and null ids take no part."""
    rows = fingerprints(df.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("t")), "id", "t").where("id is not null")
    rows = landed(rows.select("id", F.posexplode(F.slice("signatures", 1, 1 + SEEDS * level)).alias("k", "s")), "signatures")
    first = rows.where("s <> ''").groupBy("k", "s").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last")
    links = join_spread(rows, first, ["k", "s"]).where("first < id").select("first", "id")
    roots = components(cut(links.distinct()))
    return (rows.where("k = 0").select("id").distinct().join(roots.withColumnRenamed("node", "id"), "id", "left")
            .select(F.col("id").alias(id_col), F.coalesce("root", "id").alias("class_id")))


def with_next(df: DataFrame, key: str, text: str, buckets: int) -> DataFrame:
    """``df`` (key long, text) dealt out by ``_b``, ranges of (key, hash of the text), each
    with the first row of the next range as its last (``_guard``); the last one has the
    first row of all. Rows of one range are close by, so the row after a row comes by a
    window over its range. Range borders are quantiles: one number a bucket."""
    h = F.xxhash64(F.coalesce(text, F.lit("")))
    rows = df.withColumn("_h", h)
    # one number in the order of (key, hash), rounded; null keys are before all others
    x = F.when(F.col(key).isNotNull(), F.col(key) * F.lit(2.0 ** 64) + F.col("_h"))
    shares = [k / buckets for k in range(1, buckets)]
    cuts = rows.select(x.alias("x")).where("x is not null").approxQuantile("x", shares, 0.1 / buckets) if shares else []
    edges = F.array(*[F.lit(float(c)) for c in sorted(set(cuts))] or [F.lit(0.0)])
    steps = F.array(*[F.lit(1 << k) for k in range(buckets.bit_length(), -1, -1)])
    # binary search for the number of edges at or below x
    place = F.aggregate(steps, F.lit(0), lambda at, s: F.when(F.get(edges, at + s - 1) <= x, at + s).otherwise(at))
    nulls = F.floor((F.col("_h") / F.lit(2.0 ** 64) + 0.5) * buckets).cast("int") - 2 * buckets
    rows = rows.withColumn("_b", F.when(x.isNull(), nulls).otherwise(place))
    first = sorted(tuple(r) for r in rows.groupBy("_b").agg(F.min(F.struct(key, "_h")).alias("f")).select("_b", "f.*").collect())
    at = {b: k for k, (b, _, _) in enumerate(first)}
    # by bucket number: the hash of its first row, and the bucket before it
    span = range(-2 * buckets, buckets + 1)
    firsts = F.array(*[F.lit(first[at[b]][2] if b in at else None).cast("long") for b in span])
    ids = F.array(*[F.lit(first[at[b]][1] if b in at else None).cast("long") for b in span])
    before = F.array(*[F.lit(first[at[b] - 1][0] if b in at else None).cast("int") for b in span])
    k = F.col("_b") + 2 * buckets
    leads = (F.col("_h") == F.get(firsts, k)) & F.col(key).eqNullSafe(F.get(ids, k))
    mine = F.struct(F.col("_b"), F.lit(False).alias("_guard"))
    return (rows.withColumn("_to", F.when(leads, F.array(mine, F.struct(F.get(before, k).alias("_b"), F.lit(True).alias("_guard"))))
                            .otherwise(F.array(mine)))
            .select(*df.columns, "_h", F.explode("_to").alias("_to")).select(*df.columns, "_h", "_to.*").repartition("_b"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op13: fingerprints of every document and of its text with the latter half replaced."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = Window.partitionBy("_b").orderBy("_guard", "doc_id", "_h")
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("_next", F.lit(1), half))
    pairs = (with_next(docs, "doc_id", "text", buckets)
             .withColumns({"_next": F.coalesce(F.lead("text").over(order), F.lit("")), "_r": F.row_number().over(order)})
             .select("_b", "_r", "_guard", "doc_id", n.cast("long").alias("n_chars"), "text", edited.alias("edited"),
                     F.sha2(edited.cast("binary"), 256).alias("edited_sha256")))
    # rows stay where their range is: neither the aggregate nor the window deals them anew
    made = signatures(pairs, ["_b", "_r", "_guard", "doc_id", "n_chars"], {"own": "text", "new": "edited"},
                      landed(lexicon(docs), "lexicon"), ["edited_sha256"])
    return (made.withColumn("after", F.lead("own").over(Window.partitionBy("_b").orderBy("_r"))).where("not _guard")
            .select("doc_id", "n_chars", "edited_sha256", F.array_join("own", ".").alias("fingerprint"),
                    F.array_join("new", ".").alias("edited_fingerprint"), likeness(F.col("own"), F.col("new")).alias("near_edited"),
                    likeness(F.col("own"), F.col("after")).alias("near_next")))


SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
x AS (SELECT doc_id, text, length(text) AS n, coalesce(lead(text) OVER (ORDER BY doc_id), first(text) OVER (ORDER BY doc_id)) AS nxt,
             coalesce(lead(doc_id) OVER (ORDER BY doc_id), first(doc_id) OVER (ORDER BY doc_id)) AS nid FROM d),
t AS (SELECT doc_id, 0 AS v, text AS s FROM x
      UNION ALL SELECT doc_id, 1, substr(text, 1, n - n // 2) || substr(nxt, 1, n // 2) FROM x),
w AS (SELECT DISTINCT doc_id, v, unnest(regexp_split_to_array(translate(s, '{UPPER}', '{LOWER}'), '{BREAK}')) AS term FROM t),
f AS (SELECT term, md5(term) AS h FROM w WHERE v = 0 AND term <> '' GROUP BY 1
      HAVING count(*) * {RARE} >= (SELECT count(*) FROM d) AND count(*) * {COMMON} <= (SELECT count(*) FROM d)),
lex AS (SELECT term, ('0x' || h[1:10])::BIGINT AS c, list_transform(range(0, {SEEDS}), lambda s:
               least(12 - length(bin(('0x' || h[11 + 3 * s : 13 + 3 * s])::BIGINT)), {LEVELS})) AS lv FROM f),
lx AS (SELECT term, lv, CASE WHEN c >= 549755813888 THEN c - 1099511627776 ELSE c END * 16777216
              + list_sum(list_transform(range(0, {SEEDS}), lambda s: lv[s + 1]::BIGINT << (4 * s))) AS code FROM lex),
k AS (SELECT w.doc_id, w.v, list({{'code': code::BIGINT, 'lv': lv}} ORDER BY code) FILTER (lx.term IS NOT NULL) AS band,
             list(w.term ORDER BY w.term) FILTER (w.term <> '') AS every
      FROM w LEFT JOIN lx USING (term) GROUP BY 1, 2),
g AS (SELECT doc_id, v, list_concat(
        [substr(CASE WHEN band IS NULL THEN md5(coalesce(array_to_string(every, ' '), ''))
                     ELSE md5(array_to_string(list_transform(band, lambda e: e.code), ' ')) END, 1, 16)],
        flatten(list_transform(range(1, {LEVELS} + 1), lambda l: list_transform(range(1, {SEEDS} + 1), lambda s:
          CASE WHEN len(list_filter(coalesce(band, []), lambda e: e.lv[s] >= l)) = 0 THEN '' ELSE substr(md5(array_to_string(
               list_transform(list_filter(band, lambda e: e.lv[s] >= l), lambda e: e.code), ' ')), 1, 16) END)))) AS sig
      FROM t LEFT JOIN k USING (doc_id, v)),
m AS (SELECT x.doc_id, x.n, p.sig AS p, q.sig AS q, r.sig AS r FROM x JOIN g p ON p.doc_id = x.doc_id AND p.v = 0
      JOIN g q ON q.doc_id = x.doc_id AND q.v = 1 JOIN g r ON r.doc_id = x.nid AND r.v = 0)
SELECT doc_id, n AS n_chars, sha256(s) AS edited_sha256, array_to_string(p, '.') AS fingerprint, array_to_string(q, '.') AS edited_fingerprint,
       CASE WHEN p[1] = q[1] THEN 1 ELSE round(1 - pow(2.0, -len(list_filter(range(1, len(p) + 1), lambda i: p[i] = q[i] AND p[i] <> ''))::DOUBLE / {SEEDS}), 9)
       END::DOUBLE AS near_edited,
       CASE WHEN p[1] = r[1] THEN 1 ELSE round(1 - pow(2.0, -len(list_filter(range(1, len(p) + 1), lambda i: p[i] = r[i] AND p[i] <> ''))::DOUBLE / {SEEDS}), 9)
       END::DOUBLE AS near_next
FROM m JOIN (SELECT doc_id, s FROM t WHERE v = 1) e USING (doc_id)
"""
