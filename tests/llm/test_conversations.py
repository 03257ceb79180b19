import random
from functools import lru_cache
from hashlib import sha256

import pytest

from reviewmill.llm import conversations as cv

BLANK = " \t\n\x0b\x0c\r"


def brute(turns):
    """turns: (turn, role, text) in order. Faults, and the least (cost, audit, repaired rows) over all edits, by search from the front."""
    faults, seen = [], set()
    for _, role, text in turns:
        bare = text.strip(BLANK)
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    after = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}

    @lru_cache(None)
    def best(i, state, insertions):
        options = []
        if i == len(turns) and state in ("", "a"):
            options.append((0, "", ()))
        for name, role in (("u", "user"), ("a", "assistant")):
            if insertions and (state, name) in after:
                cost, audit, rows = best(i, after[state, name], insertions - 1)
                options.append((cost + 3, "I" + audit, (f"{role}:", *rows)))
        if i < len(turns):
            _, role, text = turns[i]
            cost, audit, rows = best(i + 1, state, 3)
            options.append((cost + 4, "D" + audit, rows))
            if faults[i] not in ("blank", "duplicate"):
                more = 3 * (faults[i] == "truncated")
                for letter, name, price, new in (("K", role[:1], 0, role), ("R", "u", 3, "user"), ("R", "a", 3, "assistant")):
                    if (state, name) in after:
                        cost, audit, rows = best(i + 1, after[state, name], 3)
                        options.append((cost + price + more, letter + audit, (f"{new}:{text}", *rows)))
        return min(options, default=(10**6, "", ()))

    return faults, best(0, "", 3)


def conversation(rng, key, n):
    role = lambda: rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, ""])
    text = lambda: rng.choice(["Yes.", "no", "Really? ", "", None, " \t\n", "One.", "two\n", "三。", "Done!"])
    return [(key, rng.choice([None, *range(12)]), role(), text()) for _ in range(n)]


def expected(rows):
    by = {}
    for key, turn, role, text in rows:
        by.setdefault(key, []).append((turn, " " if role is None else role, " " if text is None else text))
    out = {}
    for key, turns in by.items():
        head = lambda t: sha256(f"{len(t[1])}:{t[1]}{t[2]}".encode()).digest()
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1].encode(), t[2][:64].encode(), head(t)))
        faults, (cost, audit, kept) = brute(tuple(turns))
        numbers = {t[0] for t in turns if t[0] is not None}
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(turns, turns[1:])]
        out[" " if key is None else str(key)] = (
            max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0, *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, sha256("\n".join(kept).encode()).hexdigest())
    return out


@pytest.mark.parametrize("bits", [0, 1, 2, 16])
def test_random_conversations_equal_a_search_of_all_edits(spark, bits):
    rng = random.Random(bits)
    rows = [row for key in [None, *range(60)] for row in conversation(rng, key, rng.choice([1, 2, 3, 5, 9, 14]))]
    rows += [(100, n, "user" if n % 2 else "assistant", "Same.") for n in range(30)]
    rng.shuffle(rows)
    df = spark.createDataFrame([(*r, 7, "x") for r in rows], "conv_id long, turn long, role string, text string, row int, script string")
    got = {r.conv: tuple(r)[1:] for r in cv.summary(cv.repair(df, bits=bits)).collect()}
    assert got == expected(rows)


def test_repaired_rows_carry_their_edits(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "assistant", "Hi!"), (1, 2, "tool", "So what?"), (1, 3, "user", "")]
    df = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string")
    got = [(r.place, r.role, r.text, r.edit, r.fault, r.was) for r in cv.repair(df).collect()]
    assert "".join(g[3] for g in got) == expected(rows)["1"][6]
    assert [g[0] for g in got] == list(range(len(got)))
    assert ("blank" in [g[4] for g in got]) and all(g[2] == "" and g[5] is None for g in got if g[3] == "I")
    assert cv.summary(cv.repair(df.limit(0))).count() == 0


def test_ranks_order_whole_audits():
    programme, rng = cv.Programme(), random.Random(2)
    for _ in range(40):
        codes = "".join(rng.choices("xsuaoSUAO", k=rng.randint(1, 30)))
        found = cv.solve(programme, [(codes, None)], every=True)[0]
        audits = ["".join({"u": "I", "a": "I", "U": "R", "A": "R"}.get(c, c) for c in s) for s in found["scripts"]]
        for a in range(cv.STATES):
            for b in range(cv.STATES):
                assert (found["ranks"][a] < found["ranks"][b]) == (audits[a] < audits[b])


def test_one_long_conversation_is_spread_over_segments(spark):
    rows = [(1, n // 2, rng_role(n), "Well." if n % 5 else f"Well {n}") for n in range(4000)]
    df = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string").repartition(7)
    few, many = (cv.summary(cv.repair(df, bits=b)).first() for b in (16, 6))
    assert few == many and few.duplicate > 3000


def rng_role(n):
    return ("user", "assistant", "user", "assistant", "assistant")[n % 5]
