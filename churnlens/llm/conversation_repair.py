"""Operator 12 — conversation structure repair: lightest derivations from an agenda.

Rows of a conversation stand by turn (NULL first; equal turns by role, then by the text's
SHA-256). A repaired conversation has roles whose initials read ``(s?(ua)+)?``. Edits, a
letter each in the audit: K keeps a row (0), R gives it the role user or assistant (1), D
deletes it (2; a must for blank rows and for rows whose role and text stood before), I
inserts an empty user or assistant message (5). Truncated rows that stay add 5. Of the
cheapest audits the least in ASCII order is taken.

Repair is deduction. Item (i, q): rows i and later can be completed from role state q.
One deduction per edit leads from an item to one that stands before it; its function adds the
edit's cost and puts its letter in front, so it is monotone, and superior in (cost,
rows read, audit): K is free but reads a row. Knuth's agenda therefore pops every item
once, finally, and stops when the goal item is popped. The letter decides between two
derivations of one item and cost (each letter leads to one item only, and no audit of one
cost is the beginning of another), so items carry a back pointer instead of the audit.

Conversations may have any number of rows, so they are repaired in fragments: rows get a
global order number from a range partitioning, every ``BLOCK`` numbers are a block, and a
fragment is what a block has of a conversation. A fragment yields its lightest derivations
between every two states; those are the hyperedges of a second, small agenda over the
fragments of a conversation. In one row are gathered at most BLOCK rows without their texts,
then some 20 numbers for each fragment of a conversation, and its audit. Equal rows are
counted before anything is sorted (copies cost one deduction together), first occurrences
are minima per role and text digest, and texts only meet the edits again at the end, by order number:
no conversation, turn or text that holds a third of all rows meets in one task.

Cases: NULL role or text is one space; a NULL conv_id is a conversation; NULL turns come
first and have no part in ``gaps``; a role is judged by its first character alone; repeated
rows are duplicates; long texts are read once for their last character and digest; an
empty table gives empty results; extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlens.llm.common import WHITESPACE, save

BLOCK = 1024
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5

#: Role states: nothing yet, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
_NEXT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER,
         (USER, "a"): ASSISTANT}
_WRITTEN = {USER: "user", ASSISTANT: "assistant"}      # what R and I may write
_LEGAL = {"su", "ua", "au"}

#: Kinds of rows: s u a o by the initial, in capitals if truncated; b blank, d duplicate.
_MUST_GO = "bd"

Item = tuple[int, int]                                  # position, state
Step = tuple[Item, int, str | int]                      # item deduced, cost, letter or rank


def lightest(axioms: dict[Item, int], deductions: Callable[[Item], Iterable[Step]],
             goals: set[Item]) -> dict[Item, tuple[int, str | int, Item | None]]:
    """Knuth's algorithm: (cost, letter or rank, antecedent) of the items popped until all
    goals are final or nothing is left. Positions fall along deductions or costs rise."""
    agenda: list = [(cost, -item[0], "", item, None) for item, cost in axioms.items()]
    heapq.heapify(agenda)
    final: dict[Item, tuple[int, str | int, Item | None]] = {}
    waiting = set(goals)
    while agenda and waiting:
        cost, _, mark, item, antecedent = heapq.heappop(agenda)
        if item in final:
            continue
        final[item] = cost, mark, antecedent
        waiting.discard(item)
        for new, more, letter in deductions(item):
            if new not in final:
                heapq.heappush(agenda, (cost + more, -new[0], letter, new, item))
    return final


def _row_steps(kind: str, copies: int, after: int) -> Iterator[tuple[int, int, str]]:
    """(state before, cost, letter) of the edits of a row that lead to the state ``after``."""
    yield after, DELETE * copies, "D"
    if kind in _MUST_GO:
        return
    extra = TRUNCATED if kind.isupper() else 0
    for (before, initial), state in _NEXT.items():
        if state == after:
            if initial == kind.lower():
                yield before, KEEP + extra, "K"
            if state in _WRITTEN:
                yield before, REROLE + extra, "R"


def _inserts(after: int) -> Iterator[int]:
    """States before an inserted message that leads to ``after``."""
    for (before, _), state in _NEXT.items():
        if state == after and state in _WRITTEN:
            yield before


@dataclass(frozen=True)
class Path:
    """Lightest derivation through a fragment; ``rank``: order of its letters among those
    from the same state."""
    source: int
    target: int
    cost: int
    letters: str
    rank: int


@lru_cache(maxsize=50_000)
def paths(kinds: str, copies: tuple[int, ...]) -> tuple[Path, ...]:
    """Of a fragment: one letter per row and one per insertion before a row."""
    n = len(kinds)

    def deductions(item: Item) -> Iterator[Step]:
        i, state = item
        if i < n:
            for before in _inserts(state):
                yield (i, before), INSERT, "I"
        if i > 0:
            for before, cost, letter in _row_steps(kinds[i - 1], copies[i - 1], state):
                yield (i - 1, before), cost, letter

    found = []
    for target in range(4):
        final = lightest({(n, target): 0}, deductions, {(0, q) for q in range(4)})
        for source in range(4):
            if (0, source) in final:
                letters, item = [], (0, source)
                while item != (n, target):
                    letters.append(final[item][1])
                    item = final[item][2]
                found.append((source, "".join(letters), target, final[0, source][0]))
    out, ranks = [], [0] * 4
    for source, letters, target, cost in sorted(found):
        out.append(Path(source, target, cost, letters, ranks[source]))
        ranks[source] += 1
    return tuple(out)


#: Insertions after the last row, by state.
ENDS = {START: "", ASSISTANT: "", USER: "I", SYSTEM: "II"}


def choose(fragments: list[list[tuple[int, int, int, int]]]) -> tuple[int, list[tuple[int, int]]]:
    """Cost of a conversation and (state before, state after) per fragment; a fragment is its
    (source, target, cost, rank)."""
    n = len(fragments)

    def deductions(item: Item) -> Iterator[Step]:
        i, state = item
        for source, target, cost, rank in fragments[i - 1] if i else []:
            if target == state:
                yield (i - 1, source), cost, rank + 1

    # the insertions at the end weigh in as axioms; ranks are numbers, so is an axiom's mark
    agenda = {(n, q): INSERT * len(letters) for q, letters in ENDS.items()}
    final = lightest(agenda, deductions, {(0, START)})
    states, item = [], (0, START)
    while item is not None:
        states.append(item[1])
        item = final[item][2]
    return final[0, START][0], list(zip(states, states[1:], strict=False))


def walk(state: int, letters: str, kinds: str) -> list[tuple[int | None, str, str | None]]:
    """(row or None, letter, role written or None) of a path's steps, in order."""
    out, i = [], 0
    for letter in letters:
        row = None if letter == "I" else i
        role = None
        if letter in "IR":
            state = ASSISTANT if state == USER else USER
            role = _WRITTEN[state]
        elif letter == "K":
            state = _NEXT[state, kinds[i].lower()]
        out.append((row, letter, role))
        i += letter != "I"
    return out


# --- rows and fragments --------------------------------------------------------------------

def _ordered(conversations: DataFrame) -> DataFrame:
    """Different rows with their number of copies and ``ord``, rising with (conv_id, turn, role,
    digest of text)."""
    rows = conversations.select(
        "conv_id", F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"))
    key = ("conv_id", "turn", "role", "digest")
    counted = rows.withColumn("digest", F.unhex(F.sha2("text", 256))) \
        .groupBy(*key, "text").agg(F.count("*").alias("copies"))
    return save(counted.repartitionByRange(*key).sortWithinPartitions(*key)
                .withColumn("ord", F.monotonically_increasing_id()), "turns")


def _kind() -> Column:
    """As a first occurrence."""
    last = F.substring(F.rtrim("text", F.lit(WHITESPACE)), -1, 1)
    initial = F.substring("role", 1, 1)
    by_role = F.when(initial.isin("s", "u", "a"), initial).otherwise(F.lit("o"))
    return F.when(last == "", "b").when(last.isin(".", "!", "?"), by_role) \
        .otherwise(F.upper(by_role))


def _fragments(rows: DataFrame) -> DataFrame:
    firsts = rows.groupBy("conv_id", "role", "digest").agg(F.min("ord").alias("ord")) \
        .select("ord", F.lit(True).alias("first"))
    thin = rows.select("ord", "conv_id", "turn", "copies", F.substring("role", 1, 1).alias("initial"),
                       _kind().alias("kind"))
    judged = thin.join(firsts, "ord", "left").withColumn(
        "kind", F.when((F.col("kind") == "b") | F.col("first"), F.col("kind")).otherwise("d"))
    entry = F.struct("ord", "turn", "initial", "kind", "copies")
    return judged.groupBy("conv_id", F.expr(f"ord div {BLOCK}").alias("block")) \
        .agg(F.array_sort(F.collect_list(entry)).alias("entries"))


def _unfolded(entries: list[dict]) -> tuple[str, tuple[int, ...], list[int]]:
    """Kinds and copies of a fragment's deductions, and the entry each belongs to: further copies
    of a row are duplicates (of a blank row: blank)."""
    kinds, copies, of = [], [], []
    for k, e in enumerate(entries):
        if e["kind"] in _MUST_GO:
            parts = [(e["kind"], e["copies"])]
        else:
            parts = [(e["kind"], 1)] + [("d", e["copies"] - 1)] * (e["copies"] > 1)
        for kind, n in parts:
            kinds.append(kind)
            copies.append(n)
            of.append(k)
    return "".join(kinds), tuple(copies), of


_STATS = ("blank", "duplicate", "truncated", "illegal", "turns")
_ENDS = ("first_initial", "last_initial")
_TURNS = ("first_turn", "last_turn")


def _summary(entries: list[dict]) -> dict:
    """Counts inside a fragment and what its ends need to be joined."""
    kinds, copies, _ = _unfolded(entries)
    initials = [e["initial"] for e in entries]
    turns = [e["turn"] for e in entries if e["turn"] is not None]
    return {
        "blank": sum(n for k, n in zip(kinds, copies, strict=True) if k == "b"),
        "duplicate": sum(n for k, n in zip(kinds, copies, strict=True) if k == "d"),
        "truncated": sum(k.isupper() for k in kinds),
        # copies stand side by side, and no initial may follow itself
        "illegal": sum(a + b not in _LEGAL for a, b in zip(initials, initials[1:], strict=False))
        + sum(e["copies"] - 1 for e in entries),
        "turns": len(set(turns)), "first_initial": initials[0], "last_initial": initials[-1],
        "first_turn": min(turns, default=None), "last_turn": max(turns, default=None)}


_PATH = pa.struct([("source", pa.int32()), ("target", pa.int32()), ("cost", pa.int64()),
                   ("rank", pa.int32()), ("letters", pa.string())])
_SUMMARY = pa.struct([*[(c, pa.int64()) for c in _STATS], *[(c, pa.string()) for c in _ENDS],
                      *[(c, pa.int64()) for c in _TURNS]])
_SOLVED = ("conv_id {kind}, at long, entries array<struct<ord:long,copies:long>>, kinds string, "
           "paths array<struct<source:int,target:int,cost:long,rank:int,letters:string>>, summary "
           "struct<blank:long,duplicate:long,truncated:long,illegal:long,turns:long,"
           "first_initial:string,last_initial:string,first_turn:long,last_turn:long>")


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    entry = pa.struct([("ord", pa.int64()), ("copies", pa.int64())])
    for batch in batches:
        out: list[tuple] = []
        for entries in batch.column("entries").to_pylist():
            kinds, copies, of = _unfolded(entries)
            out.append((
                entries[0]["ord"],
                [{"ord": entries[k]["ord"], "copies": n} for k, n in zip(of, copies, strict=True)],
                kinds,
                [{"source": p.source, "target": p.target, "cost": p.cost, "rank": p.rank,
                  "letters": p.letters} for p in paths(kinds, copies)],
                _summary(entries)))
        cols = list(zip(*out, strict=True)) or [()] * 5
        types = (pa.int64(), pa.list_(entry), pa.string(), pa.list_(_PATH), _SUMMARY)
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), *[pa.array(c, t) for c, t in zip(cols, types, strict=True)]],
            names=["conv_id", "at", "entries", "kinds", "paths", "summary"])


_CHOSEN = pa.struct([("at", pa.int64()), ("source", pa.int32()), ("target", pa.int32())])
_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _join(parts: list[dict]) -> dict:
    """Counts of a conversation from its fragments', in order."""
    out = {c: sum(p[c] for p in parts) for c in _STATS}
    out["illegal"] += sum(a["last_initial"] + b["first_initial"] not in _LEGAL
                          for a, b in zip(parts, parts[1:], strict=False))
    dated = [p for p in parts if p["first_turn"] is not None]
    shared = sum(a["last_turn"] == b["first_turn"] for a, b in zip(dated, dated[1:], strict=False))
    turns = out.pop("turns") - shared
    out["gaps"] = dated[-1]["last_turn"] - dated[0]["first_turn"] + 1 - turns if dated else 0
    return out


def _combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[tuple] = []
        for parts in batch.column("parts").to_pylist():
            counts = _join([p["summary"] for p in parts])
            counts["cost"], states = choose(
                [[(p["source"], p["target"], p["cost"], p["rank"]) for p in part["paths"]]
                 for part in parts])
            out.append((*[counts[c] for c in _COUNTS], ENDS[states[-1][1]],
                        [{"at": p["at"], "source": s, "target": t}
                         for p, (s, t) in zip(parts, states, strict=True)]))
        cols = list(zip(*out, strict=True)) or [()] * (len(_COUNTS) + 2)
        types = (*[pa.int64()] * len(_COUNTS), pa.string(), pa.list_(_CHOSEN))
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), *[pa.array(c, t) for c, t in zip(cols, types, strict=True)]],
            names=["conv_id", *_COUNTS, "ending", "chosen"])


_STEP = pa.struct([("ord", pa.int64()), ("copies", pa.int64()), ("edit", pa.string()),
                   ("written", pa.string())])


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        steps = []
        for entries, kinds, letters, source, ending in zip(
                *(batch.column(c).to_pylist() for c in ("entries", "kinds", "letters", "source",
                                                       "ending")), strict=True):
            done = walk(source, letters + ending, kinds)
            steps.append([{"ord": None if i is None else entries[i]["ord"],
                           "copies": 1 if i is None else entries[i]["copies"],
                           "edit": e, "written": w} for i, e, w in done])
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), batch.column("at"), pa.array(steps, pa.list_(_STEP))],
            names=["conv_id", "at", "steps"])


# --- the operator --------------------------------------------------------------------------

@dataclass(frozen=True)
class Repair:
    """``summary``: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit.
    ``edits``: conv_id, at, place (order of the edits), edit, copies, turn, role, text;
    those that are not D are the repaired conversation."""
    summary: DataFrame
    edits: DataFrame


def repair(conversations: DataFrame) -> Repair:
    kind = conversations.schema["conv_id"].dataType.simpleString()
    rows = _ordered(conversations)
    solved = save(_fragments(rows).select("conv_id", "entries").mapInArrow(
        _solve, _SOLVED.format(kind=kind)), "fragments")
    thin = F.transform("paths", lambda p: p.dropFields("letters"))
    parts = solved.select("conv_id", F.struct("at", thin.alias("paths"), "summary").alias("part")) \
        .groupBy("conv_id").agg(F.sort_array(F.collect_list("part")).alias("parts"))
    counts = ", ".join(f"{c} long" for c in _COUNTS)
    combined = save(parts.mapInArrow(
        _combine, f"conv_id {kind}, {counts}, ending string, "
                  "chosen array<struct<at:long,source:int,target:int>>"), "combined")
    # the last fragment's path goes on with the insertions at the end
    chosen = combined.select(
        F.explode("chosen").alias("c"), F.when(
            F.col("c.at") == F.element_at("chosen", -1)["at"], F.col("ending")).otherwise("")
        .alias("ending")).select("c.*", "ending")
    letters = F.filter("paths", lambda p: (p["source"] == F.col("source"))
                       & (p["target"] == F.col("target")))[0]["letters"]
    steps = save(solved.join(chosen, "at").select(
        "conv_id", "at", "entries", "kinds", "source", "ending", letters.alias("letters"))
        .mapInArrow(_walk, f"conv_id {kind}, at long, "
                           "steps array<struct<ord:long,copies:long,edit:string,written:string>>"),
        "steps")
    text = F.array_join(F.transform("steps", lambda s: F.repeat(s["edit"], s["copies"].cast("int"))), "")
    audits = steps.select("conv_id", F.struct("at", text.alias("audit")).alias("part")) \
        .groupBy("conv_id").agg(F.array_join(F.transform(
            F.sort_array(F.collect_list("part")), lambda p: p["audit"]), "").alias("audit"))
    a, s = combined.drop("ending", "chosen").alias("s"), audits.alias("a")
    summary = a.join(s, F.col("s.conv_id").eqNullSafe(F.col("a.conv_id"))) \
        .select("s.*", "a.audit")
    edits = steps.select("conv_id", "at", F.posexplode("steps").alias("place", "step")) \
        .select("conv_id", "at", "place", "step.*")
    texts = rows.select("ord", "turn", F.col("role").alias("was"), F.col("text").alias("said"))
    edits = edits.join(texts, "ord", "left").select(
        "conv_id", "at", "place", "edit", "copies", "turn",
        F.coalesce("written", "was").alias("role"), F.coalesce("said", F.lit("")).alias("text"))
    return Repair(summary, edits)
