import hashlib
import itertools
import random
import re
import zlib
from functools import cache

import pytest
from corpusloom.llm.conversation_repair import BLANK, DUPLICATE, TRUNCATED, cheapest, damage, repair
from corpusloom.llm.queries import QUERIES

ROLES = ["system", "user", "assistant", "tool", "", " "]


def _every(turns: list[tuple[str, int]], most: int) -> tuple[int, str]:
    """The best of all edit sequences with up to ``most`` inserted turns in a row."""
    n, found = len(turns), []
    fills = ["".join(f) for k in range(most + 1) for f in itertools.product("ua", repeat=k)]
    for choice in itertools.product(["D", "K", "Ru", "Ra"], repeat=n):
        for inserts in itertools.product(fills, repeat=n + 1):
            cost, audit, roles = 0, "", ""
            for (initial, fault), edit, fill in zip([*turns, ("", 0)], [*choice, ""], inserts, strict=True):
                cost, audit, roles = cost + 5 * len(fill), audit + "I" * len(fill), roles + fill
                if edit in ("K", "Ru", "Ra") and fault in (BLANK, DUPLICATE):
                    break
                if edit == "D":
                    cost, audit = cost + 2, audit + "D"
                elif edit:
                    cost += (edit != "K") + 5 * (fault == TRUNCATED)
                    audit, roles = audit + edit[0], roles + (initial or "?" if edit == "K" else edit[1])
            else:
                if re.fullmatch("(s?(ua)+)?", roles):
                    found.append((cost, audit))
    return min(found)


def test_equals_every_edit():
    rng = random.Random(1)
    for n in range(4):
        for _ in range(40 if n < 3 else 12):
            turns = [(rng.choice("suat") if rng.random() < 0.95 else "", rng.choice([0, 0, 0, BLANK, DUPLICATE, TRUNCATED])) for _ in range(n)]
            assert cheapest(turns) == _every(turns, 2 if n < 3 else 1)


def _table_walk(turns: list[tuple[str, int]]) -> tuple[int, str]:
    """A second way: the best (cost, audit) behind each turn and last initial."""
    follow = {"": "su", "s": "u", "u": "a", "a": "u"}
    best = {"": (0, "")}

    def inserted():
        for _ in range(4):
            for last, (cost, audit) in list(best.items()):
                for r in follow[last]:
                    if r != "s":
                        best[r] = min(best.get(r, (1e9, "")), (cost + 5, audit + "I"))

    inserted()
    for initial, fault in turns:
        new = {}
        for last, (cost, audit) in best.items():
            options = [(last, cost + 2, "D")]
            if fault not in (BLANK, DUPLICATE):
                stays = cost + 5 * (fault == TRUNCATED)
                options += [(r, stays + (e == "R"), e) for r in follow[last] for e in "KR" if (e == "K" and r == initial) or (e == "R" and r != "s")]
            for r, c, e in options:
                new[r] = min(new.get(r, (1e9, "")), (c, audit + e))
        best = new
        inserted()
    return min(best.get("", (1e9, "")), best.get("a", (1e9, "")))


def test_equals_table_and_bounds_do_not_matter():
    rng = random.Random(2)
    for _ in range(400):
        turns = [(rng.choice("sssuuaat"), rng.choice([0, 0, 0, 0, BLANK, DUPLICATE, TRUNCATED])) for _ in range(rng.randint(0, 14))]
        assert cheapest(turns) == _table_walk(turns)
        if len(turns) < 7:
            assert cheapest(turns, [[0] * 4] * (len(turns) + 1)) == _table_walk(turns)


def test_long_conversation():
    rng = random.Random(4)
    turns = [(rng.choice("sua"), rng.choice([0, 0, 0, BLANK, DUPLICATE, TRUNCATED])) for _ in range(60_000)]
    cost, audit = cheapest(turns)
    assert len(audit.replace("I", "")) == len(turns) and cost > 0


@cache
def _space() -> re.Pattern:
    return re.compile(r"[^\x20\x09-\x0D]")


def _repaired(rows: list[tuple], harm: bool = True) -> list[tuple]:
    """The whole contract, row by row."""
    by_id: dict = {}
    for conv_id, turn, role, text in rows:
        own = by_id.setdefault(conv_id, [])
        role, text = (" " if v is None else v for v in (role, text))
        key = ":".join(" " if v is None else str(v) for v in (conv_id, turn))
        code = zlib.crc32(key.encode()) % 20 if harm else 19
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        own += [(turn, "user" if code == 4 else role, text)] * (0 if code == 0 else 2 if code == 3 else 1)
    out = []
    for conv_id, own in by_id.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
        seen, turns, illegal = set(), [], 0
        for (_, role, text), before in zip(own, [None, *own], strict=False):
            visible = _space().findall(text)
            turns.append((role[:1], BLANK if not visible else DUPLICATE if (role, text) in seen else TRUNCATED if visible[-1] not in ".!?" else 0))
            seen.add((role, text))
            illegal += before is not None and before[1][:1] + role[:1] not in ("su", "ua", "au")
        numbers = {r[0] for r in own} - {None}
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        cost, audit = _table_walk(turns)
        lines, left = [], iter(own)
        for edit in audit:
            new = "assistant" if lines and lines[-1][0] in ("u",) else "user"
            if edit == "I":
                lines.append((new[0], f"{new}:"))
                continue
            _, role, text = next(left)
            if edit == "K":
                lines.append((role[0], f"{role}:{text}"))
            elif edit == "R":
                lines.append((new[0], f"{new}:{text}"))
        digest = hashlib.sha256("\n".join(line for _, line in lines).encode()).hexdigest()
        out.append((conv_id, gaps, *[sum(f == w for _, f in turns) for w in (1, 2, 3)], illegal, cost, audit, digest))
    return sorted(out, key=repr)


NAMES = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def _got(df) -> list[tuple]:
    return sorted((tuple(r[c] for c in NAMES) for r in df.collect()), key=repr)


def test_awkward_conversations(spark):
    rng = random.Random(8)
    texts = [None, "", " \n\t", "One.", "One.", "Two words!", "cut off", "Really? \n", " ", "ends in 。", "x" * 5000, "a:b\nuser:c."]
    rows = [(rng.choice([None, *range(40)]), rng.choice([None, *range(6), -3, 1 << 40]), rng.choice([None, *ROLES, "user", "assistant"]), rng.choice(texts)) for _ in range(700)]
    rows += [(50, 1, "user", "Same.")] * 30 + [(51, t, "user", "Hot turn.") for t in range(300)] + [(52, None, None, None)] * 3
    schema = "conv_id long, turn long, role string, text string, audit string, fault int, digest string"
    table = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], schema).repartition(5)
    assert _got(repair(damage(table))) == _repaired(rows)
    assert _got(repair(table.filter("role IS NOT NULL AND text IS NOT NULL"))) == _repaired([r for r in rows if r[2] is not None and r[3] is not None], harm=False)


def test_empty_and_lost(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert repair(damage(spark.createDataFrame([], schema))).collect() == []
    lost = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    got = _got(repair(damage(spark.createDataFrame([(lost, 0, "user", "Gone.")], schema))))
    assert got == [(lost, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.01"])
def test_whole_table(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert _got(QUERIES["op12_conversation_repair"](spark, folder)) == _repaired(rows)
