import hashlib
import itertools
import random
import re
import zlib

import pytest

from checks.compare import connect, differences
from tests.conftest import SMALL
from tickloom.llm import queries, turns

SCHEMA = "conv_id bigint, turn bigint, role string, text string, kind string, block string, seq string"
PATTERN = re.compile("(s?(ua)+)?")


def frame(spark, rows):
    return spark.createDataFrame([(*r, "a", "b", "c") for r in rows], SCHEMA)


def edits(symbols, most_inserts):
    """Every (cost, audit) that gives a proper sequence, by trying all edits."""

    def walk(left, inserts):
        if not left:
            yield 0, "", ""
        else:
            symbol, rest = left[0], left[1:]
            extra = 3 if symbol.isupper() else 0
            for cost, audit, roles in walk(rest, inserts):
                yield cost + 4, "D" + audit, roles
                if symbol != "d":
                    yield cost + extra, "K" + audit, symbol.lower() + roles
                    for role in "ua":
                        yield cost + extra + 3, "R" + audit, role + roles
        if inserts:
            for cost, audit, roles in walk(left, inserts - 1):
                for role in "ua":
                    yield cost + 3, "I" + audit, role + roles

    return (min((c, a) for c, a, roles in walk(symbols, most_inserts) if PATTERN.fullmatch(roles)))


def dp(symbols):
    """The same by a plain table over rows and states, with whole strings."""
    moves = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}

    def inserted(best):
        for _ in range(4):
            for (i, role), j in moves.items():
                if role in "ua" and i in best:
                    new = (best[i][0] + 3, best[i][1] + "I")
                    best[j] = min(best.get(j, new), new)
        return best

    best = inserted({0: (0, "")})
    for symbol in symbols:
        extra, after = 3 if symbol.isupper() else 0, {}

        def put(j, cost, audit):
            if j is not None:
                after[j] = min(after.get(j, (cost, audit)), (cost, audit))

        for i, (cost, audit) in best.items():
            put(i, cost + 4, audit + "D")
            if symbol != "d":
                put(moves.get((i, symbol.lower())), cost + extra, audit + "K")
                for role in "ua":
                    put(moves.get((i, role)), cost + extra + 3, audit + "R")
        best = inserted(after)
    return min(best[i] for i in (0, 3) if i in best)


def solve(symbols, rules=(), block=5):
    found = turns.matrices(list(rules))
    repair = turns.Repair()
    for at in range(0, max(len(symbols), 1), block):
        repair.add(turns.compress([symbols[at : at + block]], list(rules))[0], found)
    return repair.result()


def test_program_equals_all_edits():
    for n in range(4):
        for symbols in itertools.product("suaoSUAOd", repeat=n):
            want = edits("".join(symbols), n + 1 if n < 3 else 3)
            assert solve("".join(symbols)) == want == dp("".join(symbols))


@pytest.mark.parametrize("block", [1, 3, 256])
def test_rules_and_blocks_change_nothing(block):
    r = random.Random(5)
    rules = ["ua", "us", chr(0x4E00) * 2, "dd", chr(0x4E02) + "d", "A" + chr(0x4E01)]
    for _ in range(300):
        weights = [r.random() ** 3 for _ in turns._SYMBOLS]
        symbols = "".join(r.choices(turns._SYMBOLS, weights, k=r.randrange(60)))
        assert solve(symbols, rules, block) == dp(symbols)


def test_ropes_compare_as_their_text():
    r = random.Random(1)

    def rope(depth):
        return r.choice(["", "D", "KI", "RKD"]) if depth == 0 else (rope(depth - 1), rope(depth - 1))

    for _ in range(500):
        a, b = rope(r.randrange(4)), rope(r.randrange(4))
        assert turns.precedes(a, b) == (turns.text_of(a) < turns.text_of(b))


def test_chosen_pairs_never_overlap():
    counts = [("ua", 9), ("au", 8), ("uu", 7), ("sa", 5), ("dd", 4), ("ss", 1)]
    assert turns.choose_pairs(counts, 10) == ["ua", "sa", "dd"]
    assert turns.choose_pairs(counts, 1) == ["ua"]


def brute(rows):
    """Damage and repair in plain Python, conversation by conversation."""
    known, kept = [], {}
    for conv, turn, role, text in rows:
        known.append(conv)
        show = [" " if x is None else x for x in (conv, turn, role, text)]
        kind = zlib.crc32(f"{show[0]}:{show[1]}".encode()) % 20
        role, text = show[2:]
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        kept.setdefault(conv, []).extend([(turn, role, text)] * (2 if kind == 3 else 1))
    out = []
    for conv in set(known):
        found = kept.get(conv, [])
        found.sort(
            key=lambda x: (
                x[0] is not None,
                x[0] or 0,
                hashlib.sha256(f"{len(x[1].encode())}:{x[1]}{x[2]}".encode()).digest(),
            )
        )
        seen, symbols, counts = set(), "", {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, role, text in found:
            marks = re.findall(r"[^\x20\x09-\x0D]", text)
            c = role[:1] if role[:1] in ("s", "u", "a") else "o"
            if not marks:
                symbols, name = symbols + "d", "blank"
            elif (role, text) in seen:
                symbols, name = symbols + "d", "duplicate"
            elif marks[-1] not in ".!?":
                symbols, name = symbols + c.upper(), "truncated"
            else:
                symbols, name = symbols + c, None
            seen.add((role, text))
            if name:
                counts[name] += 1
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(found, found[1:]))
        ts = [t for t, _, _ in found if t is not None]
        gaps = max(ts) - min(ts) + 1 - len(set(ts)) if ts else 0
        cost, audit = dp(symbols)
        lines, at, total = [], iter(found), len(audit) - audit.count("D")
        for letter in audit:
            row = next(at) if letter != "I" else None
            if letter != "D":
                wanted = "assistant" if (total - len(lines)) % 2 else "user"
                lines.append(f"{row[1] if letter == 'K' else wanted}:{row[2] if row else ''}")
        sha = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out.append((conv, gaps, *counts.values(), illegal, cost, audit, sha))
    return sorted(out, key=repr)


def conversations(seed, n):
    r = random.Random(seed)
    for conv in range(n):
        for turn in range(r.randrange(1, 9)):
            role = r.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = r.choice(["Yes.", "No!", "Why?", "cut of", " \n", "", None, "é. \t", "Yes.", "🙂"])
            yield conv, turn + (3 if r.random() < 0.1 else 0), role, f"{text} {turn}." if text == "No!" else text


def got(frame):
    names = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    return sorted((tuple(r) for r in frame.select(*names).collect()), key=repr)


@pytest.mark.parametrize("block", [2, 256])
def test_equals_brute_force(spark, block):
    rows = list(conversations(3, 150))
    rows += [(None, 1, "user", "Hi."), (None, None, "assistant", "Ho."), (None, 1, "user", "Hi.")]
    rows += [(500, None, None, None), (501, 7, "user", "x " * 40_000 + ".")]
    rows += [(502, t % 40, "user" if t % 3 else "assistant", f"line {t % 50}.") for t in range(400)]
    assert got(turns.repair(turns.damage(frame(spark, rows)), block)) == brute(rows)


def test_conversations_that_lose_every_row(spark):
    gone = next(k for k in range(1000) if zlib.crc32(f"{k}:1".encode()) % 20 == 0)
    found = got(turns.repair(turns.damage(frame(spark, [(gone, 1, "user", "Hi.")]))))
    assert found == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_no_rows(spark):
    assert got(turns.repair(turns.damage(frame(spark, [])))) == []


def test_query_equals_brute_force(spark):
    table = spark.read.parquet(f"{SMALL}/conversations.parquet")
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in table.collect()]
    assert got(queries.op11_conversation_repair(spark, SMALL)) == brute(rows)


def test_query_equals_its_sql(spark):
    found = queries.op11_conversation_repair(spark, SMALL).toPandas()
    want = connect(SMALL).sql(queries.sql_texts()["op11_conversation_repair"]).df()
    assert differences(found, want) == ""
