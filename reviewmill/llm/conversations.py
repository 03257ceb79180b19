"""Repair of conversations: the cheapest edits that make roles follow ``(s?(ua)+)?``, and of those the first in ASCII order.

Rows of a conversation go by turn (nulls first); rows of one turn by role, the first 64 characters of the text and its digest. A
row's first fault counts: blank (nothing but ASCII blanks), duplicate (role and text seen earlier in the conversation), truncated
(the last character that is no blank is none of ``.!?``). Edits cost: Keep 0, Rerole to user or assistant 3, Delete 4, Insert an
empty user or assistant row 3; a truncated row that stays costs 3 more; blank and duplicate rows must be deleted.

Method: a cost programme runs from the end over (row, state) nodes, where a state says which role was last. Edges that keep the
least cost are the arcs; the arcs that leave a node have different initials, so the least initial ranks a node by audits of length
1 and gives its pointer. Ranks of audits of length 2, 4, 8, … follow from pairs (rank of the node, rank of the node its pointer
leads to), and pointers are doubled with them, until all audits have ended. The ranks then order whole audits: they settle whether a
conversation is deleted wholly or begins a dialogue where both cost the same. The path itself is read off through the
doubled pointers, 1, 2, 4, … steps at once.

Rows are placed by ranges of (conversation, order) and cut into segments of at most ``2**bits`` rows, so that a conversation of any
length is spread over tasks. A conversation inside one segment is solved at once. For the few that cross a segment's edge, each
segment first yields its least cost from every state to every state; these are folded from the end, which gives the costs
behind each segment; then each segment is solved for all states it may be entered in, and the walk over the segments picks one.
Only the last step goes through a conversation row by row: edits are applied to the sorted rows as they stream by.

Defined cases: a null role or text is one space. A conversation of null id is one conversation. An empty role fits nowhere and is
rewritten or deleted. Empty tables give empty results; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from reviewmill.llm.common import slices
from reviewmill.operators import running
from reviewmill.session import publish

BLANKS = " \t\n\x0b\x0c\r"
KEEP, REROLE, DELETE, INSERT, CUT = 0, 3, 4, 3, 3
FAR = 1 << 40
#: States: all rows deleted; nothing yet of a dialogue; last row by the system, the user, the assistant.
GONE, OPEN, SYSTEM, USER, ASSISTANT = range(5)
STATES = 5
#: Whom a state may be followed by, and the state after.
AFTER = {"s": {OPEN: SYSTEM}, "u": {OPEN: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
ENDS = [0, FAR, FAR, FAR, 0]
STOP, D, I, K, R = range(5)
#: The character of an edit by its letter and the state after it: K, D; U, A for a new role; u, a for an inserted row.
EDIT_SIGNS = np.array([list("?????"), list("DDDDD"), list("???ua"), list("KKKKK"), list("???UA")])

#: A row's code: x must be deleted; s, u, a, o (another role) by initial, in capitals if truncated. A dot ends the conversation.
END = "."


def _options(code: str) -> list[tuple[int, int, int, int]]:
    """(state, letter, cost, state after) of the edits that use up a row."""
    if code == END:
        return []
    out = [(s, D, DELETE, s) for s in range(STATES)]
    if code != "x":
        more = CUT if code.isupper() else 0
        out += [(s, K, KEEP + more, t) for s, t in AFTER.get(code.lower(), {}).items()]
        out += [(s, R, REROLE + more, t) for role in "ua" for s, t in AFTER[role].items()]
    return out


INSERTS = [(s, t) for role in "ua" for s, t in AFTER[role].items()]


class Programme:
    """The cost programme as a table: (costs behind a row, its code) -> costs before it and the least arc of each state.

    Costs are kept relative to the least of them; as only few such vectors occur, each step is computed once and then looked up.
    """

    def __init__(self) -> None:
        self.known: dict[tuple[tuple[int, ...], str], tuple[tuple[int, ...], int, int]] = {}
        #: By number: the least letter of each state, and how far on the node is that it leads to. Number 0 stops everywhere.
        self.letters: list[list[int]] = [[STOP] * STATES]
        self.jumps: list[list[int]] = [[0] * STATES]

    def step(self, behind: tuple[int, ...], code: str) -> tuple[tuple[int, ...], int, int]:
        """(relative costs, their offset, number of the arcs)."""
        found = self.known.get((behind, code))
        if found is None:
            found = self.known[behind, code] = self._compute(behind, code)
        return found

    def _compute(self, behind: tuple[int, ...], code: str) -> tuple[tuple[int, ...], int, int]:
        options = _options(code)
        cost = list(behind) if code == END else [FAR] * STATES
        for s, _, c, t in options:
            cost[s] = min(cost[s], c + behind[t])
        for _ in range(2):  # an insertion may follow another
            for s, t in INSERTS:
                cost[s] = min(cost[s], INSERT + cost[t])
        letter, jump = [STOP] * STATES, [0] * STATES
        for s in range(STATES):
            arcs = [(e, STATES + t - s) for f, e, c, t in options if f == s and c + behind[t] == cost[s]]
            arcs += [(I, t - s) for f, t in INSERTS if f == s and INSERT + cost[t] == cost[s]]
            if arcs:
                letter[s], jump[s] = min(arcs)
        self.letters.append(letter)
        self.jumps.append(jump)
        least = min(cost)
        return tuple(c - least if c < FAR else FAR for c in cost), least, len(self.letters) - 1

    def run(self, codes: str, behind: list[int]) -> tuple[list[int], list[int]]:
        """Costs from each state before the first row, and the arcs' numbers, row by row."""
        least = min(behind)
        costs, total, arcs = tuple(c - least if c < FAR else FAR for c in behind), least, []
        for code in reversed(codes):
            costs, more, arc = self.step(costs, code)
            total += more
            arcs.append(arc)
        return [c + total if c < FAR else FAR for c in costs], arcs[::-1]

    def matrix(self, codes: str) -> list[int]:
        """Least cost from every state before the rows to every state behind them, row-major."""
        columns = [self.run(codes, [0 if s == t else FAR for s in range(STATES)])[0] for t in range(STATES)]
        return [columns[t][s] for s in range(STATES) for t in range(STATES)]


def rank_paths(letter: np.ndarray, pointer: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Ranks of the whole audits of all nodes, and the pointers over 1, 2, 4, … steps; nodes that stop point to themselves."""
    rank, pointers = letter.astype(np.int64), [pointer]
    while True:
        pair = rank * (int(rank.max(initial=0)) + 1) + rank[pointer]
        _, rank = np.unique(pair, return_inverse=True)
        if np.array_equal(pointer[pointer], pointer):
            return rank, pointers
        pointer = pointer[pointer]
        pointers.append(pointer)


def follow(start: int, pointers: list[np.ndarray], letter: np.ndarray) -> np.ndarray:
    """The nodes of the least path from ``start`` on, up to where it stops, each doubled pointer doubling what is known of it."""
    path = np.array([start], pointers[0].dtype)
    for pointer in pointers:
        path = np.concatenate([path, pointer[path]])
        if letter[path[-1]] == STOP:
            break
    return path[:int(np.argmax(letter[path] == STOP)) + 1]


def _script(path: np.ndarray, letter: np.ndarray, first: int) -> str:
    """A path as one sign an edit."""
    return "".join(EDIT_SIGNS[letter[path[:-1]], (path[1:] - first) % STATES].tolist())


def solve(programme: Programme, segments: list[tuple[str, list[int] | None]], every: bool) -> list[dict]:
    """Costs, and for each state a segment may be entered in (or just the best start): rank, state at its end, script.

    A segment is (codes, costs behind it); without costs it ends its conversation. All segments are ranked together.
    """
    out, arcs = [], []
    for codes, behind in segments:
        whole = codes + END if behind is None else codes
        costs, own = programme.run(whole, ENDS if behind is None else behind)
        out.append({"costs": costs, "first": STATES * len(arcs)})
        arcs += own if behind is None else [*own, 0]
    letter = np.array(programme.letters, np.int8)[arcs].ravel()
    pointer = np.arange(len(letter), dtype=np.int32) + np.array(programme.jumps, np.int32)[arcs].ravel()
    rank, doubled = rank_paths(letter, pointer)
    for found in out:
        at = found["first"]
        found["ranks"] = rank[at:at + STATES].tolist()
        entries = range(STATES) if every else [min((GONE, OPEN), key=lambda s: (found["costs"][s], found["ranks"][s]))]
        found["scripts"], found["exits"] = [""] * STATES, [0] * STATES
        for s in entries:
            path = follow(at + s, doubled, letter)
            found["scripts"][s], found["exits"][s] = _script(path, letter, at), int(path[-1] - at) % STATES
        found["start"] = entries[0]
    return out


# --- the rows of conversations in order ----------------------------------------------------------

def ordered_turns(rows: DataFrame, key: str, turn: str, role: str, text: str) -> DataFrame:
    """Stored rows in order: (conv, turn, role, text, digest, row, code, fault) without duplicates marked."""
    conv = F.coalesce(F.col(key).cast("string"), F.lit(" "))
    filled = rows.select(conv.alias("conv"), F.col(turn).alias("turn"), *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(n)
                                                                        for c, n in ((role, "role"), (text, "text"))])
    digest = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"), 256))
    ready = filled.withColumns({"digest": digest, "head": F.substring("text", 1, 64), "copy": F.monotonically_increasing_id()})
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("head"), F.col("digest"), F.col("copy")]
    stored = running.place(ready, order, "part", "row", "turns").drop("part", "head", "copy")
    bare = F.rtrim(F.col("text"), F.lit(BLANKS))
    fault = F.when(bare == "", "blank").when(~F.right(bare, F.lit(1)).isin(".", "!", "?"), "truncated")
    initial = F.when(F.left("role", F.lit(1)).isin("s", "u", "a"), F.left("role", F.lit(1))).otherwise("o")
    code = F.when(bare == "", "x").when(fault == "truncated", F.upper(initial)).otherwise(initial)
    return stored.withColumns({"fault": fault, "code": code})


def _segments(turns: DataFrame, bits: int) -> DataFrame:
    """Stored (conv, segment, first, codes), duplicates marked; a segment has at most ``2**bits`` rows."""
    narrow = turns.select("conv", "digest", "row", "code")
    repeated = publish(narrow.filter("code != 'x'").groupBy("conv", "digest").agg(
        F.min("row").alias("origin"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"), "repeated-turns")
    marked = narrow.join(repeated, ["conv", "digest"], "left").select(
        "conv", "row", F.when(F.col("row") > F.col("origin"), "x").otherwise(F.col("code")).alias("code"))
    listed = F.sort_array(F.collect_list(F.struct("row", "code")))
    return publish(marked.groupBy("conv", F.shiftright("row", bits).alias("segment")).agg(
        F.min("row").alias("first"), F.array_join(listed.getField("code"), "").alias("codes")), "segments")


def _mapped(df: DataFrame, schema: str, compute) -> DataFrame:
    """``compute(list of row dicts) -> list of row dicts`` on slices of Arrow batches."""
    kind = StructType.fromDDL(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(kind)
        for piece in slices(batches):
            yield pa.RecordBatch.from_pylist(compute(piece.to_pylist()), schema=target)

    return df.mapInArrow(run, kind)


SCRIPT = "conv string, segment long, first long, codes string, script string"


def _whole(segments: DataFrame) -> DataFrame:
    """Scripts of conversations that lie in one segment."""
    programme = Programme()

    def compute(rows: list[dict]) -> list[dict]:
        found = solve(programme, [(r["codes"], None) for r in rows], every=False) if rows else []
        return [{"conv": r["conv"], "segment": r["segment"], "first": r["first"], "codes": r["codes"], "script": f["scripts"][f["start"]]}
                for r, f in zip(rows, found, strict=True)]

    return _mapped(segments.select("conv", "segment", "first", "codes"), SCRIPT, compute)


def _crossing(segments: DataFrame) -> DataFrame:
    """Scripts of conversations of several segments."""
    programme = Programme()
    with_matrix = _mapped(segments.select("conv", "segment", "codes"), "conv string, segment long, matrix array<long>", lambda rows: [
        {"conv": r["conv"], "segment": r["segment"], "matrix": programme.matrix(r["codes"])} for r in rows])

    def fold(rows: list[dict]) -> list[dict]:
        """The costs behind each segment, from the last one on."""
        out = []
        for r in rows:
            behind = programme.run(END, ENDS)[0]
            for n, part in enumerate(reversed(r["parts"])):
                out.append({"conv": r["conv"], "segment": part["segment"], "behind": behind if n else None})
                matrix = np.array(part["matrix"]).reshape(STATES, STATES)
                behind = (matrix + np.array(behind)).min(axis=1).tolist()
        return out

    listed = F.sort_array(F.collect_list(F.struct("segment", "matrix")))
    behind = _mapped(with_matrix.groupBy("conv").agg(listed.alias("parts")), "conv string, segment long, behind array<long>", fold)

    def each(rows: list[dict]) -> list[dict]:
        found = solve(programme, [(r["codes"], r["behind"]) for r in rows], every=True) if rows else []
        return [{**{n: r[n] for n in ("conv", "segment", "first", "codes")}, **{n: f[n] for n in ("costs", "ranks", "exits", "scripts")}}
                for r, f in zip(rows, found, strict=True)]

    joined = segments.join(behind, ["conv", "segment"]).select("conv", "segment", "first", "codes", "behind")
    solved = publish(_mapped(joined, "conv string, segment long, first long, codes string, costs array<long>, ranks array<long>, exits array<int>, "
                                     "scripts array<string>", each), "solved")

    def walk(rows: list[dict]) -> list[dict]:
        """The state in which each segment is entered on the least path."""
        out = []
        for r in rows:
            parts = r["parts"]
            costs = parts[0]["costs"]
            starts = [s for s in (GONE, OPEN) if costs[s] == min(costs[GONE], costs[OPEN])]
            states = list(starts)
            for part in parts:  # the first segment whose pieces differ settles which start is less
                ranks = [part["ranks"][s] for s in states]
                if len(set(ranks)) > 1:
                    starts = [starts[ranks.index(min(ranks))]]
                    break
                states = [part["exits"][s] for s in states]
            state = starts[0]
            for part in parts:
                out.append({"conv": r["conv"], "segment": part["segment"], "entry": state})
                state = part["exits"][state]
        return out

    listed = F.sort_array(F.collect_list(F.struct("segment", "costs", "ranks", "exits")))
    entries = _mapped(solved.groupBy("conv").agg(listed.alias("parts")), "conv string, segment long, entry int", walk)
    return solved.join(entries, ["conv", "segment"]).select(
        "conv", "segment", "first", "codes", F.get("scripts", "entry").alias("script"))


def scripts(turns: DataFrame, bits: int) -> DataFrame:
    """(conv, segment, first, codes, script): the codes and edits of every segment's rows, starting with row ``first``."""
    segments = _segments(turns, bits)
    edges = segments.groupBy("segment").agg(F.min_by("conv", "first").alias("a"), F.max_by("conv", "first").alias("b"))
    edges = publish(edges.select(F.explode(F.array("a", "b")).alias("conv"), "segment").distinct().groupBy("conv").agg(
        F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"), "crossing")  # two a segment at most
    whole = _whole(segments.join(edges, "conv", "left_anti"))
    return whole.unionByName(_crossing(segments.join(edges, "conv", "left_semi")))


EDITED = "conv string, place long, turn {turn}, role string, text string, edit string, fault string, was string"
EDIT = {"K": "K", "D": "D", "U": "R", "A": "R", "u": "I", "a": "I"}
ROLE = {"u": "user", "a": "assistant"}


def repair(rows: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", bits: int = 16) -> DataFrame:
    """Every row with its edit (K, R, D) and the inserted rows (I): (conv, place, turn, role, text, edit, fault, was).

    ``conv`` is the key as a string, one space for null; ``place`` counts a conversation's edits from 0; ``role`` is the new role and
    ``was`` the old one; a row with the edit D is to go. The rows of a conversation come together and in order.
    """
    turns = ordered_turns(rows, key, turn, role, text)
    kind = rows.schema[turn].dataType.simpleString()
    nothing = F.lit(None).cast("string")
    edits = scripts(turns, bits).select("conv", F.col("first").alias("row"), F.lit(0).alias("kind"), F.lit(None).cast(kind).alias("turn"),
                                        nothing.alias("role"), nothing.alias("text"), nothing.alias("fault"), "codes", "script")
    given = turns.select("conv", "row", F.lit(1).alias("kind"), "turn", "role", "text", "fault", nothing.alias("codes"), nothing.alias("script"))
    stream = edits.unionByName(given).repartition("conv").sortWithinPartitions("conv", "row", "kind")
    schema = StructType.fromDDL(EDITED.format(turn=kind))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(schema)
        conv, codes, script, row, at, place = None, "", "", 0, 0, 0

        def inserted(out: list[dict]) -> None:
            nonlocal at, place
            while at < len(script) and script[at] in ROLE:
                out.append({"conv": conv, "place": place, "turn": None, "role": ROLE[script[at]], "text": "", "edit": "I", "fault": None, "was": None})
                at, place = at + 1, place + 1

        for piece in slices(batches, 1024):
            out: list[dict] = []
            for r in piece.to_pylist():
                if r["kind"] == 0:  # a segment's edits come before its rows; what is left of the last one's are rows at the end
                    inserted(out)
                    place = place if r["conv"] == conv else 0
                    conv, codes, script, row, at = r["conv"], r["codes"], r["script"], 0, 0
                    continue
                inserted(out)
                edit = script[at]
                changed = ROLE.get(edit.lower()) or r["role"]
                fault = "duplicate" if codes[row] == "x" and r["fault"] != "blank" else r["fault"]
                out.append({"conv": conv, "place": place, "turn": r["turn"], "role": changed, "text": r["text"], "edit": EDIT[edit],
                            "fault": fault, "was": r["role"]})
                row, at, place = row + 1, at + 1, place + 1
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=target)
        out = []
        inserted(out)
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=target)

    return stream.mapInArrow(run, schema)


SUMMARY = ("conv string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
           "repaired_sha256 string")
LEGAL = frozenset({"su", "ua", "au"})
COST = {"K": KEEP, "R": REROLE, "D": DELETE, "I": INSERT}


def summary(repaired: DataFrame) -> DataFrame:
    """One row a conversation of ``repair``'s rows, in the order it gives them: faults, cost, audit, digest of what stays.

    A digest runs through its rows one after the other, so a conversation is read by one task, as a stream; a task holds one batch and the
    audits of the conversations that end in it.
    """
    schema = StructType.fromDDL(SUMMARY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(schema)
        now: dict | None = None

        def finished() -> dict:
            turns = now["last"] - now["low"] + 1 - now["distinct"] if now["distinct"] else 0
            return {"conv": now["conv"], "gaps": turns, "audit": "".join(now["audit"]), "repaired_sha256": now["sha"].hexdigest(),
                    **{n: now[n] for n in ("blank", "duplicate", "truncated", "illegal", "cost")}}

        for piece in slices(batches, 1024):
            out: list[dict] = []
            for r in piece.to_pylist():
                if now is None or r["conv"] != now["conv"]:
                    if now is not None:
                        out.append(finished())
                    now = {"conv": r["conv"], "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "cost": 0, "audit": [],
                           "sha": sha256(), "joint": "", "was": None, "low": None, "last": None, "distinct": 0}
                edit = r["edit"]
                now["audit"].append(edit)
                now["cost"] += COST[edit] + (CUT if r["fault"] == "truncated" and edit in "KR" else 0)
                if edit != "I":
                    if r["fault"]:
                        now[r["fault"]] += 1
                    initial = r["was"][:1]
                    now["illegal"] += now["was"] is not None and now["was"] + initial not in LEGAL
                    now["was"] = initial
                    if r["turn"] is not None and r["turn"] != now["last"]:
                        now["low"] = r["turn"] if now["low"] is None else now["low"]
                        now["last"], now["distinct"] = r["turn"], now["distinct"] + 1
                if edit != "D":
                    now["sha"].update(f"{now['joint']}{r['role']}:{r['text']}".encode())
                    now["joint"] = "\n"
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=target)
        if now is not None:
            yield pa.RecordBatch.from_pylist([finished()], schema=target)

    return repaired.mapInArrow(run, schema)
