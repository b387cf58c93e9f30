import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetmeter.llm import role_repair as r

CONVERSATIONS = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("turn", T.LongType()),
        T.StructField("role", T.StringType()),
        T.StructField("text", T.StringType()),
    ]
)
LEGAL = re.compile("(s?(ua)+)?")


def table(spark, rows):
    return spark.createDataFrame(rows, CONVERSATIONS).repartition(3)


def after_damage(rows):
    found = []
    for conv, turn, role, text in rows:
        conv_, turn_ = (" " if x is None else str(x) for x in (conv, turn))
        fault = zlib.crc32(f"{conv_}:{turn_}".encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        row = (turn, "user" if fault == 4 else role, text)
        found += [row] * (0 if fault == 0 else 2 if fault == 3 else 1)
    return sorted(found, key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), x[2].encode()))


def faults(rows):
    seen, found = set(), []
    for _, role, text in rows:
        ink = text.rstrip(" \t\n\x0b\x0c\r")
        fault = "blank" if not ink else "duplicate" if (role, text) in seen else ""
        seen.add((role, text))
        found.append(fault or ("" if ink[-1] in ".!?" else "truncated"))
    return found


def search(rows, marks, at=0, roles=""):
    """All edits that can still lead to a legal end: (cost, letters, lines), without a stack."""
    if len(roles) > 2 * len(rows) + 2 or not LEGAL.fullmatch(roles) and not LEGAL.fullmatch(
        roles + ("a" if roles[-1:] == "u" else "ua")
    ):
        return
    if at == len(rows) and LEGAL.fullmatch(roles):
        yield 0, "", ()
    nexts = []
    if not roles.endswith("II"):
        for role in ("user", "assistant"):
            nexts.append((5, "I", role, "", at))
    if at < len(rows):
        _, role, text = rows[at]
        nexts.append((2, "D", None, None, at + 1))
        if marks[at] not in ("blank", "duplicate"):
            late = 5 if marks[at] == "truncated" else 0
            nexts.append((late, "K", role, text, at + 1))
            nexts += [(1 + late, "R", new, text, at + 1) for new in ("user", "assistant")]
    for cost, letter, role, text, to in nexts:
        more = "" if role is None else role[:1] or "-"
        for c, letters, lines in cheapest(tuple(rows), tuple(marks), to, roles + more)[:1]:
            line = () if role is None else (f"{role}:{text}",)
            yield cost + c, letter + letters, line + lines


@lru_cache(maxsize=None)
def cheapest(rows, marks, at, roles):
    return sorted(search(rows, marks, at, roles))[:1]


def plain(rows):
    """A row by row table over the same four situations, letters and lines written out: for
    conversations that are too long for ``search``, and itself tested by it."""
    shift = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "x", ("x", "u"): "u"}
    inserts = {"": ["", "u", "ua"], "s": ["", "u", "ua"], "u": ["", "a"], "x": ["", "u"]}
    names = {"u": "user", "a": "assistant"}
    live = {"": (0, "", ())}
    marks = faults(rows)
    for (_, role, text), mark in zip(rows, marks):
        offers = {}

        def offer(top, new):
            offers[top] = min(new, offers.get(top, new))

        for top, (cost, letters, lines) in live.items():
            offer(top, (cost + 2, letters + "D", lines))
            if mark in ("blank", "duplicate"):
                continue
            late = 5 if mark == "truncated" else 0
            for added in inserts[top]:
                at, given = top, lines
                for x in added:
                    at, given = shift[at, x], given + (f"{names[x]}:",)
                base = cost + 5 * len(added) + late, letters + "I" * len(added)
                if (at, role[:1]) in shift:
                    offer(shift[at, role[:1]], (base[0], base[1] + "K", given + (f"{role}:{text}",)))
                for x, name in names.items():
                    if (at, x) in shift:
                        offer(shift[at, x], (base[0] + 1, base[1] + "R", given + (f"{name}:{text}",)))
        live = offers
    ends = {"": [], "s": ["user:", "assistant:"], "u": ["assistant:"], "x": []}
    return min(
        (cost + 5 * len(ends[t]), letters + "I" * len(ends[t]), lines + tuple(ends[t]))
        for t, (cost, letters, lines) in live.items()
    )


def expected(rows, by=plain):
    result = {}
    for conv in {x[0] for x in rows}:
        mine = after_damage([x for x in rows if x[0] == conv])
        marks = faults(mine)
        cost, letters, lines = by(mine)
        turns = {t for t, _, _ in mine if t is not None}
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(mine, mine[1:])]
        result[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            *(marks.count(x) for x in ("blank", "duplicate", "truncated")),
            sum(p not in ("su", "ua", "au") for p in pairs),
            cost,
            letters,
            hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return result


def found(df):
    return {
        x.conv_id: (x.gaps, x.blank, x.duplicate, x.truncated, x.illegal, x.cost, x.audit, x.repaired_sha256)
        for x in df.collect()
    }


def random_rows(conversations, length, seed, roles=("system", "user", "assistant", "tool", "", None, "usr", "Agent")):
    rng = random.Random(seed)
    texts = ["Yes.", "no", "Why?", "", " \t", None, "a long. text\n", "Ünï!", "x" * 50, "ok.\r\n"]
    rows = []
    for conv in range(conversations):
        for i in range(rng.randint(1, length)):
            weights = [2, 8, 8] + [1] * (len(roles) - 3)
            role = rng.choices(roles, weights)[0]
            turn = rng.choice([i, i, i, i, i + 3, None, i // 2])
            rows.append((conv, turn, role, rng.choice(texts) if rng.random() < 0.4 else f"{rng.random()}."))
    return rows


def by_search(rows):
    return cheapest(tuple(rows), tuple(faults(rows)), 0, "")[0]


@pytest.mark.parametrize("seed", range(3))
def test_short_conversations_equal_a_search_of_all_edits(seed):
    rows = random_rows(60, 5, seed)
    for conv in range(60):
        mine = after_damage([x for x in rows if x[0] == conv])
        assert plain(mine) == by_search(mine)


def test_random_conversations(spark):
    rows = random_rows(300, 9, 7)
    rows += [(None, i, "user" if i % 2 else "assistant", f"{i}.") for i in range(6)]
    rows += [(-5, None, None, None), (-6, 2**40, "user", "Far away."), (-6, -(2**40), "user", "Here.")]
    docs = table(spark, rows).selectExpr("*", "1 AS conv", "2 AS piece", "3 AS cost", "'a' AS kind", "4 AS copies")
    assert found(r.repairs(docs)) == expected(rows)


@pytest.fixture
def uncoalesced(spark):
    """Small pieces are not put together, so that a piece is a task."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    yield
    spark.conf.unset(name)


def test_long_conversations_lie_in_many_pieces(spark, uncoalesced):
    rng = random.Random(3)
    rows = [
        (conv, turn, rng.choice(["user", "assistant", "assistant", "user", "system"]),
         rng.choice([f"text {turn}.", f"text {turn}", "Same.", ""]))
        for conv in (1, 2, 3) for turn in range(900)
    ]
    rows += [(2, None, "user", f"without turn {i}.") for i in range(200)]
    rows += [(4, 1, "user", "the same row.")] * 50 + [(4, 2, "assistant", "Yes.")] * 30
    pieces = r.with_faults(r.damaged(table(spark, rows))).repartitionByRange(*r._in_order())
    assert pieces.groupBy(F.spark_partition_id()).count().count() == 8
    assert found(r.repairs(table(spark, rows))) == expected(rows)


def test_a_conversation_of_equal_sayings_is_spread(spark, uncoalesced, monkeypatch):
    from fleetmeter.operators import join_back
    monkeypatch.setattr(join_back, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(r, "join_groups", lambda *a: join_back.join_groups(*a, broadcast_rows=0))
    rows = [(1, t, "user" if t % 2 else "assistant", "Yes." if t % 3 else f"{t}.") for t in range(400)]
    assert found(r.repairs(table(spark, rows))) == expected(rows)


def test_all_rows_dropped_and_empty_table(spark):
    assert r.repairs(table(spark, [])).collect() == []
    dropped = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    empty = hashlib.sha256(b"").hexdigest()
    assert found(r.repairs(table(spark, [(dropped, 0, "user", "Hello.")]))) == {
        dropped: (0, 0, 0, 0, 0, 0, "", empty)
    }


def test_the_cache_stays_small():
    rng = random.Random(5)
    r._after.cache_clear()
    parse = r.Parse(r.EMPTY)
    for _ in range(20_000):
        parse.read(r.Row(rng.choice("suax"), rng.random() < 0.1, rng.random() < 0.2))
    assert r._after.cache_info().currsize < 2_000
    assert len(parse.letters(r.accepted(parse.ends())[0])) >= 20_000
