"""Line dedup by a deletion-neighbourhood join. DataFrame functions only.

A line's words are its parts between white space. A line occurrence is removed when an
earlier occurrence, by (doc_id, line number), holds the same words, or, if both lines
have at least ``min_words`` words, words at an edit distance of one (one word put in,
left out or replaced); with ``two_from``, of two where both have that many words. Lines
are judged on the input, not on what is left.

1. Every line occurrence becomes one narrow row: 128-bit hash, position, word count
   and the hashes of its first and last m words (m: about half the words, the same
   for most neighbouring lengths). One edit cannot touch both ends, so a line with a
   partner shares one of these keys with a *different* line. Lines without such a
   key can have no partner. This loses no pair.
2. The words of the others are fetched by one join. The same test follows for blocks of
   ``BLOCK`` words: an edit lies in one block, and partners agree before and after it.
   A line goes on only with the blocks for which another line agrees.
3. There it emits its deletion neighbourhood as hashed keys: for each word of the block,
   (place, length, hash without it) and (length, hash without it), and once (length,
   hash) of all its words. A line's other deletions can equal no other line's.
4. Equal keys are joined. Lines with an equal place key differ in that word only.
   Lines with an equal length key are a whole line and lines that a word was put into.
   So a key needs no pairs: each member is compared with the earliest member only.
5. Each (line, earliest partner) is verified on the words by edit distance.
6. A line hash's limit is the earliest of its first position and its verified
   partners'; every occurrence after the limit goes.

Two edits (``two_from``) go the same way besides it. Of three parts of m words (m: about
a third, anchored at the start, near the start and at the end) the first one intact
after as many edits as parts shares its key, the middle one at a shift of one at most.
A line that shares such a key is cut into pieces (``PIECES``): two edits lie in two
pieces, and partners agree outside them at a shift. Of the lines that so agree each is
verified against the earliest. A group that this does not settle is divided by rare words:
in any one order of the words inside the two pieces, lines within two edits share one of
their first three; here words that the earliest lacks come first, by thirds of their
hashes, the rarest in the group ahead. Open lines are verified against the earlier ones of their division, if it holds
``FEW`` open lines at most. If it holds more, all its lines emit their deletion neighbourhood
of two words inside the two pieces, typed by place, so that here, too, a line is only
compared with the earliest of equal keys. This loses no pair, and no group costs the
square of its size.

All aggregates are minima and counts (map-side); joins on a line or variant hash are
exchanged for themselves, so that a line that makes up a third of all rows is split.
Before the join of step 2, rows are tested against a broadcast set of row-key buckets
(``BUCKETS`` at most, whatever the input), so that few texts are exchanged for it.

Defined results: a null text stays null, an empty one has one blank line. Blank lines
are never removed. A null doc_id comes before all others. Rows that repeat a doc_id
share its line positions: equal places don't remove each other. Other columns pass
through whatever their names (map columns are not supported); an empty table gives
an empty one.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import join_spread, landed, table

BLANK, BLANKS = "[\\t\\r\\x0B\\f]", "\t\r\x0b\f"
ROW = ["_r1", "_r2"]
LINE = ["_h1", "_h2"]
BLOCK = 8
BUCKETS = 1 << 20
PIECES = 4
FEW = 32


def _words(line: Column) -> Column:
    """A split by one character is far faster than by a pattern, so the few lines with other
    blanks get spaces for them."""
    plain = F.when(line.rlike(BLANK), F.translate(line, BLANKS, " " * len(BLANKS))).otherwise(line)
    return F.array_remove(F.split(plain, " "), "")


def _half(n: Column) -> Column:
    """How many words at either end make a key; at most half of ``n``."""
    return F.floor(n / 8).cast("int") * 4


def _ends(w: Column, n: Column, m: Column) -> list[Column]:
    return [F.xxhash64(F.lit(1), m, F.slice(w, F.lit(1), m)),
            F.xxhash64(F.lit(2), m, F.slice(w, n - m + 1, m))]


def _part(tag: int, m: Column, start: Column) -> Column:
    return F.struct(F.lit(tag).alias("tag"), m.cast("int").alias("m"), start.cast("int").alias("start"))


def _hashed_parts(w: Column, parts: list[Column]) -> Column:
    """The distinct hashes of many parts (tag, number of words, first word) of ``w``: one hash
    in a function over the parts, as ten hash expressions make a method too long for
    the JVM's compiler."""
    return F.array_distinct(F.transform(F.array(*parts), lambda x: F.xxhash64(x["tag"], x["m"], F.slice(w, x["start"], x["m"]))))


def _rows(df: DataFrame, id_col: str, text: str) -> DataFrame:
    """The input with a 128-bit key of each row."""
    return df.select(F.xxhash64(*df.columns).alias("_r1"), F.xxhash64(F.lit(1), *df.columns).alias("_r2"),
                     F.col(id_col).alias("_id"), F.col(text).alias("_text"))


def _split(rows: DataFrame) -> DataFrame:
    # blank lines go before the split: a test of the number of words would split twice
    return (rows.select(*ROW, "_id", F.posexplode(F.split("_text", "\n")).alias("_no", "_line"))
            .where(F.btrim("_line", F.lit(" " + BLANKS)) != "")
            .select(*ROW, "_id", "_no", _words(F.col("_line")).alias("_w")).withColumn("_n", F.size("_w")))


def _hashes() -> list[Column]:
    return [F.xxhash64("_w").alias("_h1"), F.xxhash64(F.lit(1), "_w").alias("_h2")]


def line_table(rows: DataFrame, min_words: int, two_from: int | None = None) -> DataFrame:
    """One narrow row per line with words: ``_keys`` of its ends, and with ``two_from``
    ``_keys2`` of three of its parts, null for shorter lines."""
    w, n = F.col("_w"), F.col("_n")
    m, shorter = _half(n), _half(n - 1)
    out = [F.when(n >= min_words, F.when((n > min_words) & (shorter != m), F.array(*_ends(w, n, m), *_ends(w, n, shorter)))
                  .otherwise(F.array(*_ends(w, n, m)))).alias("_keys")]
    if two_from is not None:
        def third(words: Column) -> Column:
            return F.floor(words / 9).cast("int") * 3
        thirds = third(n), third(F.greatest(n - 2, F.lit(two_from)))
        parts = [p for m in thirds for p in (_part(3, m, F.lit(1)), _part(5, m, n - m + 1), *(_part(4, m, m + k) for k in range(3)))]
        out.append(F.when(n >= two_from, _hashed_parts(w, parts)).alias("_keys2"))
    return _split(rows).select(*ROW, "_id", "_no", *_hashes(), *out)


def _pos() -> Column:
    """(id, line number) as one number of a fixed width."""
    first = F.coalesce(F.col("_id").cast("decimal(20,0)"), F.lit("-9223372036854775809").cast("decimal(20,0)"))
    return first * F.lit(1 << 32).cast("decimal(10,0)") + F.col("_no")


def edit_distance_is_one_or_less(a: Column, b: Column) -> Column:
    """Of two word arrays."""
    def put_in(s: Column, long: Column) -> Column:
        differs = F.zip_with(s, F.slice(long, F.lit(1), F.size(s)), lambda p, q: p != q)
        at = F.array_position(differs, True).cast("int")  # 0: the new word is the last
        return (at == 0) | (F.slice(s, F.greatest(at, F.lit(1)), F.size(s))
                            == F.slice(long, at + 1, F.size(long)))
    replaced = F.size(F.filter(F.zip_with(a, b, lambda p, q: p != q), lambda x: x)) <= 1
    return (F.when(F.size(a) == F.size(b), replaced)
            .when(F.size(a) + 1 == F.size(b), put_in(a, b))
            .when(F.size(a) == F.size(b) + 1, put_in(b, a)).otherwise(False))


def edit_distance_is_two_or_less(a: Column, b: Column) -> Column:
    """Of two word arrays."""
    def rest(s: Column, at: Column) -> Column:
        return F.slice(s, at, F.size(s))
    differs = F.array_position(F.zip_with(a, b, lambda p, q: ~p.eqNullSafe(q)), True).cast("int")
    # 0: the arrays are equal; the first word that differs is replaced, left out or put in
    after = [(1, 1), (0, 1), (1, 0)]
    return F.when(differs == 0, True).when(F.abs(F.size(a) - F.size(b)) > 2, False).otherwise(reduce(or_, (
        edit_distance_is_one_or_less(rest(a, differs + i), rest(b, differs + j)) for i, j in after)))


def _bucket(key: str) -> Column:
    return F.pmod(F.col(key), F.lit(BUCKETS))


def _agreeing(keyed: DataFrame, member: str) -> DataFrame:
    """The rows of ``keyed`` whose ``_key`` another ``member`` has too. Rows are first
    tested against a broadcast set of key buckets, so that few are exchanged again."""
    shared = landed(keyed.groupBy("_key").agg(F.min(member).alias("_lo"), F.max(member).alias("_hi"))
                    .where("_lo < _hi").select("_key"), "line-shared")
    some = (keyed.withColumn("_b", _bucket("_key"))
            .join(F.broadcast(shared.select(_bucket("_key").alias("_b")).distinct()), "_b", "left_semi").drop("_b"))
    return join_spread(some, shared, "_key")


def _lines_with_partners(rows: DataFrame, lines: DataFrame, keys: str, many_keys: bool = False) -> DataFrame:
    """(line hash, _pos, _i, _w) of the distinct lines that another line agrees with in
    one of ``keys``; ``_i`` numbers them in the order of their first positions."""
    keyed = lines.where(F.col(keys).isNotNull()).select(*LINE, *ROW, "_id", "_no", F.explode(keys).alias("_key"))
    if many_keys:
        agreeing = _agreeing(keyed, "_h1")
    else:
        shared = (keyed.groupBy("_key").agg(F.min("_h1").alias("_lo"), F.max("_h1").alias("_hi"))
                  .where("_lo < _hi").select("_key"))
        agreeing = join_spread(keyed, shared, "_key")
    # the first occurrence stands for a line; its row gives the words
    found = landed(agreeing.groupBy(*LINE)
                   .agg(F.min(F.struct(_pos().alias("_pos"), "_no", *ROW)).alias("_s")).select(*LINE, "_s.*"),
                   "line-places")
    bucket = _bucket("_r1")
    wanted = found.groupBy(*ROW).agg(F.collect_list(F.struct(*LINE, "_pos", "_no")).alias("_at"))
    some = rows.withColumn("_b", bucket).join(
        F.broadcast(found.select(bucket.alias("_b")).distinct()), "_b", "left_semi")
    # a text is split once, not once for each of its lines
    texts = some.join(wanted, ROW).select("_at", F.split("_text", "\n").alias("_l")).select(F.explode(
        F.when(F.size("_l") > 0, F.transform("_at", lambda s: F.struct(s.alias("_s"), F.get("_l", s["_no"]).alias("_line"))))).alias("_x"))
    # rows that repeat as a whole give their lines once
    line = texts.select("_x._s.*", "_x._line").select(*LINE, "_pos", _words(F.col("_line")).alias("_w"))
    return landed(line.dropDuplicates(LINE).orderBy("_pos").withColumn("_i", F.monotonically_increasing_id()),
                  "line-words")


def _partners(rows: DataFrame, lines: DataFrame) -> DataFrame:
    """(line hash, position of an earlier line at edit distance one)."""
    line = _lines_with_partners(rows, lines, "_keys")
    w, n = F.col("_w"), F.size("_w")
    # blocks, in the frame of the line's own length and of the length one shorter
    frames = line.select("_i", "_w", F.explode(F.array(n, n - 1)).alias("_n"))
    after = F.greatest(F.col("_n") - (F.col("_b") + 1) * BLOCK, F.lit(0))
    blocks = (frames.select("_i", "_w", "_n", F.explode(F.sequence(
        F.lit(0), F.floor((F.col("_n") - 1) / BLOCK).cast("int"))).alias("_b"))
        .select("_i", "_n", "_b", F.xxhash64(
            "_n", "_b", F.slice(w, F.lit(1), F.col("_b") * BLOCK),
            F.when(after > 0, F.slice(w, F.greatest(n - after, F.lit(0)) + 1, after))).alias("_key")))
    agreed = (blocks.groupBy("_key").agg(F.min("_i").alias("_lo"), F.max("_i").alias("_hi"))
              .where("_lo < _hi").select("_key"))
    live = join_spread(blocks, agreed, "_key").select("_i", "_n", "_b")

    def without(i: Column) -> Column:
        return F.concat(F.slice("_w", F.lit(1), i), F.slice("_w", i + 2, n))
    live = live.join(line.select("_i", "_w"), "_i")
    first = F.col("_b") * BLOCK
    own = F.transform(F.sequence(first, F.least(first + BLOCK, n) - 1), lambda i: F.struct(
        F.xxhash64(F.lit("place"), i, n, without(i)).alias("_v"), F.lit(0).alias("_put")))
    longer = F.transform(F.sequence(first, F.least(first + BLOCK, n - 1)), lambda i: F.struct(
        F.xxhash64(F.lit("length"), n - 1, without(i)).alias("_v"), F.lit(1).alias("_put")))
    whole = F.array(F.struct(F.xxhash64(F.lit("length"), n, "_w").alias("_v"), F.lit(0).alias("_put")))
    variants = landed(live.select("_i", F.explode(F.when(F.col("_n") == n, F.concat(own, whole))
                                                  .otherwise(longer)).alias("_s"))
                      .select("_i", "_s._v", "_s._put").distinct(), "line-variants")
    earliest = (variants.groupBy("_v")
                .agg(F.min("_i").alias("_any"), F.min(F.when(F.col("_put") == 0, F.col("_i"))).alias("_whole"),
                     F.max("_i").alias("_last")).where("_any < _last").drop("_last"))
    # a line that a word was put into is compared with the whole line, not with its like
    pairs = (join_spread(variants, earliest, "_v")
             .select("_i", F.when(F.col("_put") == 1, F.col("_whole")).otherwise(F.col("_any")).alias("_e"))
             .where("_e < _i").distinct())
    other = line.select(F.col("_i").alias("_e"), F.col("_w").alias("_ew"), F.col("_pos").alias("_c"))
    return (pairs.join(line.select(*LINE, "_i", "_w"), "_i").join(other, "_e")
            .where(edit_distance_is_one_or_less(F.col("_w"), F.col("_ew"))).select(*LINE, "_c"))


def _pieces(n: Column) -> dict[str, Column]:
    """Where a line of ``n`` words is cut for a way (_d, _p, _q, _s): the first piece that is
    left out begins at ``a`` and ends at ``b``, the other one begins at ``c`` and ends at ``e``."""
    d, frame = F.col("_d"), n - F.col("_d")

    def cut(piece: Column) -> Column:
        return F.floor(frame * piece / PIECES).cast("int")
    p, q, s = F.col("_p"), F.col("_q"), F.col("_s")
    return {"a": cut(p), "b": cut(p + 1) + s, "c": cut(q) + s, "e": cut(q + 1) + d}


WAYS = [(d, p, q, s) for d in range(3) for p in range(PIECES) for q in range(p + 1, PIECES)
        for s in ([0] if q == p + 1 else [-1, 0, 1] if d == 0 else range(d + 1))]


def _piece_keys(line: DataFrame, two_from: int) -> DataFrame:
    """(_i, _keys): for each of ``WAYS`` the hash of a line without two of its pieces (_p and
    _q), in the frame of its own length and of ``_d`` words less, the words between the two
    at a shift ``_s``; null where the frame is too short. Words stand in by their hashes."""
    n = F.size("_x")

    def key(way: Column) -> Column:
        d, p, q, s = (way[c] for c in "dpqs")
        frame = n - d

        def cut(piece: Column) -> Column:
            return F.floor(frame * piece / PIECES).cast("int")
        middle = F.slice("_x", cut(p + 1) + s + 1, cut(q) - cut(p + 1))
        return F.when(frame >= two_from, F.xxhash64(frame, p, q, F.slice("_x", F.lit(1), cut(p)), middle,
                                                    F.slice("_x", cut(q + 1) + d + 1, n)))
    ways = F.array(*[F.struct(*[F.lit(v).alias(c) for c, v in zip("dpqs", way)]) for way in WAYS])
    return line.select("_i", F.transform("_w", lambda x: F.xxhash64(x)).alias("_x")).select(
        "_i", F.transform(ways, key).alias("_keys"))


def _inside(member: DataFrame, line: DataFrame) -> DataFrame:
    """(_i, _key, _way, _x, _mark) of lines in a group: the hashed words in the two pieces, with
    a mark between the pieces (at ``_mark``, -1 for none)."""
    way = F.element_at(F.array(*[F.struct(*[F.lit(v).alias(f"_{c}") for c, v in zip("dpqs", w)]) for w in WAYS]), F.col("_way") + 1)
    rows = member.join(line.select("_i", F.transform("_w", lambda x: F.xxhash64(x)).alias("_x")), "_i").select(
        "_i", "_key", "_way", "_x", F.size("_x").alias("_n"), way.alias("_y")).select("_i", "_key", "_way", "_x", "_n", "_y.*")
    at = _pieces(F.col("_n"))
    # neighbouring pieces have nothing between them that holds still, and so no mark
    apart = F.col("_q") > F.col("_p") + 1
    part = F.when(apart, F.concat(F.slice("_x", at["a"] + 1, at["b"] - at["a"]), F.array(F.lit(0).cast("long")),
                                  F.slice("_x", at["c"] + 1, at["e"] - at["c"]))).otherwise(
        F.slice("_x", at["a"] + 1, at["e"] - at["a"]))
    return rows.select("_i", "_key", "_way", part.alias("_x"), F.when(apart, at["b"] - at["a"]).otherwise(-1).alias("_mark"))


def _third(word: Column) -> Column:
    return F.pmod(word, F.lit(3).cast("long"))


def _divided(member: DataFrame, line: DataFrame) -> DataFrame:
    """(_i, _key, _way, _parts, _part): the divisions of its group that a line is in, three at most.
    Two edits take two words from a line at most, so of the words that two lines within
    two edits have in common the first is among either's first three, in whatever order
    holds for the whole group. Repeated words count once."""
    words = landed(_inside(member, line).select("_i", "_key", "_way", F.array_distinct("_x").alias("_x")), "line-inside")
    early = (words.join(member.groupBy("_key").agg(F.min("_i").alias("_i")), ["_key", "_i"])
             .groupBy("_key").agg(F.min("_x").alias("_ex")))
    # the order: words that the earliest lacks, by thirds of their hashes so that a line need not
    # count all of them, the rarest of a third ahead; then the earliest's words, by hash
    split = join_spread(words, early, "_key").select(
        "_i", "_key", "_way", F.array_except("_x", "_ex").alias("_new"),
        F.slice(F.array_sort(F.array_intersect("_x", "_ex")), 1, 3).alias("_old"))
    split = split.withColumn("_to", F.coalesce(F.get(F.array_sort(F.transform("_new", _third)), F.lit(2)), F.lit(2)))
    word = landed(split.select("_i", "_key", "_way", F.explode(F.concat(
        F.transform(F.filter("_new", lambda w: _third(w) <= F.col("_to")), lambda w: F.struct(_third(w).alias("_class"), w.alias("_t"))),
        F.transform("_old", lambda w: F.struct(F.lit(3).cast("long").alias("_class"), w.alias("_t"))))).alias("_s"))
        .select("_i", "_key", "_way", "_s.*"), "line-rare")
    often = word.groupBy("_key", "_t").agg(F.count("*").alias("_often"))
    rank = F.struct("_class", F.when(F.col("_class") == 3, 0).otherwise(F.col("_often")).alias("_often"), "_t")
    return (join_spread(word, often, ["_key", "_t"]).groupBy("_i", "_key", "_way")
            .agg(F.slice(F.array_sort(F.collect_list(rank)), 1, 3).alias("_first"))
            .select("_i", "_key", "_way", F.transform("_first", lambda x: F.xxhash64("_key", x["_t"])).alias("_parts"))
            .select("*", F.explode("_parts").alias("_part")))


def _open_variants(member: DataFrame, line: DataFrame) -> DataFrame:
    """(_i, _v, _role) of lines in a group: the hashed deletion variants of the words in the
    two pieces, x (with a mark between the pieces), by which any two lines within two
    edits are found without comparing pairs. Content of x: the whole (role 0), with
    one word out (1), with two out (2). With a place: two words out and the place of one
    of them (4), against one word out at that place (3). With two places (5)."""
    rows = _inside(member, line).select("_i", "_key", "_x", "_mark")
    n = F.size("_x")
    places = F.filter(F.sequence(F.lit(0), n - 1), lambda i: i != F.col("_mark"))

    def out(i: Column, j: Column | None = None) -> Column:
        if j is None:
            return F.concat(F.slice("_x", F.lit(1), i), F.slice("_x", i + 2, n))
        return F.concat(F.slice("_x", F.lit(1), i), F.slice("_x", i + 2, j - i - 1), F.slice("_x", j + 2, n))

    def variant(role: int, kind: int, content: Column, *where: Column) -> Column:
        where = [*where, F.lit(-1), F.lit(-1)][:2]
        return F.struct(F.xxhash64("_key", F.lit(kind), *where, content).alias("_v"), F.lit(role).alias("_role"))

    def two(i: Column) -> Column:
        later = F.filter(F.sequence(i, n - 1), lambda j: (j > i) & (j != F.col("_mark")))
        return F.flatten(F.transform(later, lambda j: F.array(
            variant(2, 0, out(i, j)), variant(4, 1, out(i, j), i), variant(4, 1, out(i, j), j - 1), variant(5, 2, out(i, j), i, j))))
    one = F.flatten(F.transform(places, lambda i: F.array(variant(1, 0, out(i)), variant(3, 1, out(i), i))))
    every = F.concat(F.array(variant(0, 0, F.col("_x"))), one, F.flatten(F.transform(places, two)))
    return rows.select("_i", F.explode(every).alias("_s")).select("_i", "_s.*").distinct()


def _variant_pairs(variants: DataFrame) -> DataFrame:
    """(_i, _e): of each line the earliest that an equal variant shows to be close. Lines
    with the same whole or one word out are two edits apart at most; so are lines with two
    words out and the whole, or with one of these at the other's place, or both at equal ones."""
    role = F.col("_role")
    least = variants.groupBy("_v").agg(*[F.min(F.when(role == r, F.col("_i"))).alias(f"_m{r}") for r in range(6)],
                                       F.min("_i").alias("_lo"), F.max("_i").alias("_hi")).where("_lo < _hi").drop("_lo", "_hi")
    m = [F.col(f"_m{r}") for r in range(6)]
    earliest = (F.when(role == 0, F.least(*m[:3])).when(role == 1, F.least(*m[:2])).when(role == 2, m[0])
                .when(role == 3, F.least(*m[3:5])).when(role == 4, m[3]).otherwise(m[5]))
    return join_spread(variants, least, "_v").select("_i", earliest.alias("_e")).where("_e < _i")


def _two_edit_partners(rows: DataFrame, lines: DataFrame, two_from: int) -> DataFrame:
    """(line hash, position of an earlier line at an edit distance of up to two), at
    least one for each line that has such a line."""
    line = _lines_with_partners(rows, lines, "_keys2", many_keys=True)
    keys = landed(_piece_keys(line, two_from), "line-pieces")
    ways = keys.select("_i", F.posexplode("_keys").alias("_way", "_key")).where("_key is not null")
    member = landed(_agreeing(ways, "_i"), "line-members")
    other = line.select(F.col("_i").alias("_e"), F.col("_w").alias("_ew"), F.col("_pos").alias("_c"))

    def verified(pairs: DataFrame) -> DataFrame:
        return (pairs.distinct().join(line, "_i").join(other, "_e").where("_c < _pos")
                .where(edit_distance_is_two_or_less(F.col("_w"), F.col("_ew"))).select(*LINE, "_i", "_c"))
    groups = landed(member.groupBy("_key").agg(F.min("_i").alias("_e"), F.count("*").alias("_many")), "line-groups")
    settled = landed(verified(join_spread(member, groups, "_key").where("_e < _i").select("_i", "_e")), "line-settled")
    # what the earliest of the group doesn't settle, in groups of more than two lines
    known = settled.select("_i").distinct()
    left = landed(join_spread(member.select("_i", "_key"), groups.where("_many > 2"), "_key").where("_i > _e")
                  .join(known, "_i", "left_anti").select("_i", "_key").distinct(), "line-open")
    divided = landed(_divided(join_spread(member, left.select("_key").distinct(), "_key"), line), "line-divided")
    opened = divided.join(left, ["_i", "_key"]).select("_i", "_part", "_parts").distinct()
    parts = landed(opened.groupBy("_part").agg(F.count("*").alias("_open")), "line-open-parts")
    few = join_spread(opened, parts.where(F.col("_open") <= FEW).select("_part"), "_part")
    # lines that share several divisions are compared in one of them
    earlier = divided.select("_part", F.col("_i").alias("_e"), F.col("_parts").alias("_theirs"))
    once = F.array_min(F.array_intersect("_parts", "_theirs")) == F.col("_part")
    found = [settled, landed(verified(few.join(earlier, "_part").where((F.col("_e") < F.col("_i")) & once).select("_i", "_e")),
                             "line-near")]
    large = parts.where(F.col("_open") > FEW).select("_part")
    if not large.isEmpty():
        crowd = join_spread(divided, large, "_part").select("_i", "_key", "_way").distinct()
        variants = landed(_open_variants(crowd, line), "line-open-variants")
        found.append(landed(verified(_variant_pairs(variants)), "line-near"))
    return reduce(DataFrame.union, found).select(*LINE, "_c")


def dedup_lines(df: DataFrame, id_col: str = "doc_id", text: str = "text", min_words: int = 8,
                two_from: int | None = None) -> DataFrame:
    """(id, n_lines, removed, kept_text) and the row key columns ``ROW``, one row per
    input row; ``removed`` is the sorted array of the line numbers that go."""
    if min_words < 8:
        raise ValueError("lines of under eight words are too short to lose one")
    if two_from is not None and two_from < 16:
        raise ValueError("lines of under sixteen words are too short to lose two")
    rows = _rows(df, id_col, text)
    lines = landed(line_table(rows, min_words, two_from), "lines")
    firsts = lines.groupBy(*LINE).agg(F.min(_pos()).alias("_first"), F.max(_pos()).alias("_last"))
    partners = _partners(rows, lines)
    if two_from is not None:
        partners = landed(partners, "line-partners").union(_two_edit_partners(rows, lines, two_from))
    near = partners.groupBy(*LINE).agg(F.min("_c").alias("_c"))
    limits = (firsts.join(near, LINE, "left").where("_first < _last or _c is not null")
              .select(*LINE, F.least("_first", "_c").alias("_limit")))
    gone = (join_spread(lines.select(*LINE, *ROW, "_id", "_no"), limits, LINE)
            .where(_pos() > F.col("_limit"))
            .groupBy(*ROW).agg(F.sort_array(F.collect_set("_no")).alias("_gone")))
    kept = F.when(F.col("_gone").isNull(), F.col("_text")).otherwise(F.array_join(
        F.transform(F.array_except(F.sequence(F.lit(0), F.size("_l") - 1), "_gone"), lambda i: F.get("_l", i)), "\n"))
    return rows.join(gone, ROW, "left").withColumn("_l", F.split("_text", "\n")).select(
        *ROW, F.col("_id").alias("_id"), F.coalesce(F.size("_l"), F.lit(0)).alias("n_lines"),
        F.coalesce("_gone", F.array().cast("array<int>")).alias("removed"), kept.alias("kept_text"))


def drop_lines(df: DataFrame, id_col: str = "doc_id", text: str = "text", min_words: int = 8,
               two_from: int | None = None) -> DataFrame:
    """``df``, its columns in order, with the removed lines taken out of ``text``."""
    made = dedup_lines(df, id_col, text, min_words, two_from)
    # the other columns join by the row key; rows that repeat as a whole once
    rest = [c for c in df.columns if c not in (id_col, text)]
    if not rest:
        return made.select(F.col("_id").alias(id_col), F.col("kept_text").alias(text)).select(*df.columns)
    other = df.select(F.xxhash64(*df.columns).alias("_r1"), F.xxhash64(F.lit(1), *df.columns).alias("_r2"),
                      F.struct(*rest).alias("_rest")).dropDuplicates(ROW)
    return (made.join(other, ROW)
            .select(F.col("_id").alias(id_col), F.col("kept_text").alias(text), "_rest.*").select(*df.columns))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op4: what line dedup leaves of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select(
        F.col("_id").alias("doc_id"), F.col("n_lines").cast("long"),
        F.size("removed").cast("long").alias("n_removed"),
        F.sha2(F.coalesce("kept_text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


SQL = r"""
WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents),
o AS (SELECT doc_id, i AS no, l[i] AS line,
             list_filter(regexp_split_to_array(l[i], '[ \t\r\x0B\f]+'), lambda x: x <> '') AS w
      FROM d, unnest(range(1, len(l) + 1)) AS u(i)),
x AS (SELECT array_to_string(w, ' ') AS k, min((doc_id, no)) AS pos, any_value(w) AS w, any_value(len(w)) AS n
      FROM o WHERE len(w) > 0 GROUP BY 1),
v AS (SELECT k, pos, n, i, array_to_string(list_concat(w[1:i-1], w[i+1:]), ' ') AS r
      FROM x, unnest(range(1, n + 1)) AS u(i) WHERE n >= 8),
e AS (SELECT a.k, min(b.pos) AS pos FROM v a JOIN v b ON a.r = b.r AND a.i = b.i AND a.n = b.n AND b.pos < a.pos GROUP BY 1
      UNION ALL SELECT v.k, min(x.pos) FROM v JOIN x ON v.r = x.k AND x.n >= 8 AND x.pos < v.pos GROUP BY 1
      UNION ALL SELECT x.k, min(v.pos) FROM v JOIN x ON v.r = x.k AND x.n >= 8 AND v.pos < x.pos GROUP BY 1),
lim AS (SELECT k, min(pos) AS pos FROM (SELECT k, pos FROM x UNION ALL SELECT k, pos FROM e) GROUP BY 1),
f AS (SELECT o.doc_id, o.no, o.line, coalesce(lim.pos < (o.doc_id, o.no), false) AS gone
      FROM o LEFT JOIN lim ON array_to_string(o.w, ' ') = lim.k)
SELECT d.doc_id, coalesce(len(d.l), 0) AS n_lines, coalesce(g.n, 0)::BIGINT AS n_removed,
       sha256(coalesce(g.kept, '')) AS kept_sha256
FROM d LEFT JOIN (SELECT doc_id, count(*) FILTER (gone) AS n,
                         string_agg(line, chr(10) ORDER BY no) FILTER (NOT gone) AS kept FROM f GROUP BY 1) g USING (doc_id)
"""
