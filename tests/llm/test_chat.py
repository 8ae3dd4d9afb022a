import heapq
import random

import pytest

from shelfprice.llm import chat as C


def cheapest(roles):
    """Dijkstra over (turns read, state), one edit at a time."""
    heap, best = [(0, 0, "start")], {}
    while heap:
        cost, i, s = heapq.heappop(heap)
        if (i, s) in best:
            continue
        best[i, s] = cost
        if i == len(roles) and s in C.ACCEPT:
            return cost
        for r in C.LEGAL[s]:
            heapq.heappush(heap, (cost + C.INSERT, i, r))
        if i < len(roles):
            label = lambda r: 0 if r == roles[i] else C.RELABEL if roles[i] in C.STATES[1:] else C.UNKNOWN
            for r in C.LEGAL[s]:
                heapq.heappush(heap, (cost + label(r), i + 1, r))
            if s != "start":
                heapq.heappush(heap, (cost + C.MERGE + label(s), i + 1, s))


def rows():
    rnd = random.Random(2)
    out = []
    for conv in [*range(40), None]:
        for t in range(rnd.randrange(1, 9)):
            out.append((conv, t, rnd.choice(["system", "user", "assistant", "tool", None, "user"]), rnd.choice(["x", "", None, "y <|im_end|> z"])))
    out += [(100, t, rnd.choice(["user", "assistant"]), f"t{t}") for t in range(700)]  # spans many partitions
    out += [(101, 5, "user", "same")] * 60 + [(102, None, "assistant", "a"), (102, 1, "user", "b")]
    return out


def grouped(found):
    convs = {}
    for r in sorted(found, key=lambda r: r.position):
        convs.setdefault(r.conv_id, []).append(r)
    return convs


@pytest.fixture(scope="module")
def repaired(spark):
    df = spark.createDataFrame([(*r, "x") for r in rows()], "conv_id long, turn int, role string, text string, cost string")
    out = []
    old = spark.conf.get("spark.sql.shuffle.partitions")
    for parts in (1, 9, 40):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        out.append(C.repair(df.repartition(3)).collect())
    spark.conf.set("spark.sql.shuffle.partitions", old)
    return out


def test_cost_is_the_least(repaired):
    for conv, turns in grouped(repaired[0]).items():
        assert sum(t.cost for t in turns) == cheapest([t.role for t in turns]), conv


def test_result_is_legal_and_renders(repaired):
    for turns in grouped(repaired[1]).values():
        roles, text = [], ""
        for t in turns:
            roles += t.inserted_before
            if t.action.startswith("merge"):
                assert roles[-1] == t.new_role
            else:
                roles.append(t.new_role)
            roles += t.inserted_after
            text += t.rendered
        state = "start"
        for r in roles:
            assert r in C.LEGAL[state]
            state = r
        assert state in C.ACCEPT
        assert [x.split("\n")[0] for x in text.split(C.OPEN)[1:]] == roles
        assert text.count(C.CLOSE) == len(roles) and text.endswith(C.CLOSE + "\n")


def test_partitions_change_nothing(repaired):
    def plain(found):
        return sorted(((k is None, k or 0), [(t.turn, t.role, t.new_role, t.action, t.inserted_before, t.inserted_after, t.cost, t.rendered)
                                            for t in v]) for k, v in grouped(found).items())
    assert len(repaired[0]) == len(rows())
    assert plain(repaired[0]) == plain(repaired[1]) == plain(repaired[2])


def test_empty(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert C.repair(df).count() == 0
