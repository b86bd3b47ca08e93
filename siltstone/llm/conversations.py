"""Repairs the turn structure of conversations at least cost, with dynamic programming over a shared grammar.

A conversation's rows, by turn, should have role initials `(s?(ua)+)?`. Edits: Keep costs 0, Rerole to user or assistant 1,
Delete 2 (the only edit of blank and duplicate rows), Insert of an empty user or assistant turn 5; a truncated row that
stays costs 5 more. Of the cheapest edit sequences the one with the ASCII-least initials (the audit) is taken.

1. Each row becomes a symbol of role initial and fault. Duplicates are found from keys and SHA-256 digests of texts, so texts
   do not move; equal rows are counted before they are shuffled.
2. Rows are range-partitioned by conversation and order and written as blocks of at most `BLOCK` symbols, with counts that
   can be added up. A conversation of any length is thereby cut over tasks.
3. Re-Pair: each round the most frequent pairs of neighbouring symbols in the distinct blocks, as far as they cannot
   overlap one another, become rules. The grammar is bounded (`LEVELS` rounds of `PAIRS` rules): what is left of a block is
   multiplied symbol by symbol, so the result does not depend on the grammar.
4. Per rule one min-plus transfer matrix over the four states of the pattern (nothing yet, after s, after u, after a), whose
   cells hold a cost and an audit rope; rules are evaluated bottom-up, once, and sent to all tasks.
5. Per conversation its blocks' matrices are chained, then its rows pass once, in order, as a sorted stream: edits are
   applied and the repaired turns given out or hashed. The SHA-256 of one conversation is sequential by definition, so its rows
   pass one task; that task holds one batch, one audit and four ropes.

Ropes are compared character by character, never by hashes. No audit of equal cost over equal rows is a proper prefix of
another (the rest would be insertions, which cost), so the least audits of parts make the least audit of the whole.

Edge cases: a null role or text is one space; null turns come first; rows of one turn stand by role, then by their text's SHA-256;
a null conv_id is a conversation; repeated rows are rows, so all but the first are duplicates; a role with another initial, or none,
is legal nowhere; a conversation that lost all rows has zeros, an empty audit and no turns; texts of any length
are whole, an audit has to fit a string; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import release, remove_folder, shared_folder, written

BLOCK = 4096
LEVELS = 10
PAIRS = 200
SPACE = " \t\n\x0b\f\r"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
LEGAL = ("su", "ua", "au")

_FLAT = 64  # characters up to which a rope is one string
_FIRST_RULE = 0xE000  # rules are characters of the private use area


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies: rows with the faults that crc32(`conv_id:turn`) % 20 names.

    0 drops the row (copies 0, the rest null), 1 empties its text, 2 removes `.!?`, 3 repeats it (copies 2), 4 makes it a user's.
    """
    conv, turn = F.col("conv_id").cast("long"), F.col("turn").cast("long")
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    named = F.concat(*(F.coalesce(x.cast("string"), F.lit(" ")) for x in (conv,)), F.lit(":"), F.coalesce(turn.cast("string"), F.lit(" ")))
    hit = F.crc32(named.cast("binary")) % 20
    there = hit != 0
    return conversations.select(
        conv.alias("conv_id"),
        F.when(there, turn).alias("turn"),
        F.when(there, F.when(hit == 4, F.lit("user")).otherwise(role)).alias("role"),
        F.when(there, F.when(hit == 1, F.lit("")).when(hit == 2, F.translate(text, ".!?", "")).otherwise(text)).alias("text"),
        F.when(hit == 0, 0).when(hit == 3, 2).otherwise(1).cast("int").alias("copies"),
    )


# --- rows to symbols -------------------------------------------------------------------------------

_ORDER = ("conv_id", "turn", "role", "digest")


def _prepared(rows: DataFrame) -> DataFrame:
    copies = F.col("copies").cast("int") if "copies" in rows.columns else F.lit(1)
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    there = copies > 0
    return rows.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.when(there, F.col("turn").cast("long")).alias("turn"),
        F.when(there, role).alias("role"),
        F.when(there, F.unhex(F.sha2(text, 256))).alias("digest"),
        F.when(there, text).alias("text"),
        copies.alias("copies"),
    )


def _initial(role: Column) -> Column:
    first = F.substring(role, 1, 1)
    return F.when(first.isin("s", "u", "a"), first).otherwise("o")


def marked(rows: DataFrame) -> DataFrame:
    """Different rows in keys alone: conv_id, turn, role, digest, blank, cut, copies, first (no equal role and text earlier)."""
    end = F.rtrim(F.col("text"), F.lit(SPACE))
    thin = rows.withColumn("blank", end == "").withColumn("cut", ~F.right(end, F.lit(1)).isin(".", "!", "?"))
    thin = thin.groupBy(*_ORDER, "blank", "cut").agg(F.sum("copies").alias("copies"))
    return thin


def _with_first(thin: DataFrame) -> DataFrame:
    firsts = thin.filter("copies > 0 AND NOT blank").groupBy("conv_id", "role", "digest").agg(F.min(F.struct("turn")).alias("least"))
    firsts = firsts.select("conv_id", F.col("least.turn").alias("turn"), "role", "digest", F.lit(False).alias("blank"), F.lit(False).alias("cut"), F.lit(0).cast("long").alias("copies"), F.lit(1).alias("first"))
    both = thin.withColumn("first", F.lit(0)).unionByName(firsts)
    return both.groupBy(*_ORDER).agg(F.max("blank").alias("blank"), F.max("cut").alias("cut"), F.sum("copies").alias("copies"), F.max("first").alias("first"))


_BLOCK_FIELDS = [("conv_id", pa.int64()), ("seq", pa.int64()), ("symbols", pa.string())] + [
    (c, pa.int64()) for c in ("blank", "duplicate", "truncated", "illegal", "turns", "first_turn", "last_turn")
] + [("first_role", pa.string()), ("last_role", pa.string())]
_BLOCK_ARROW = pa.schema(_BLOCK_FIELDS)
_BLOCK = ", ".join(f"{n} {'string' if t == pa.string() else 'long'}" for n, t in _BLOCK_FIELDS)


def _blocks(most: int):
    """Symbols of sorted rows in blocks of one conversation; counts hold within the block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        seq = TaskContext.get().partitionId() << 40
        now: object = _blocks  # no conversation yet
        out, symbols, size = [], [], 0
        counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "turns"), 0)
        ends: dict = dict.fromkeys(("first_turn", "last_turn", "first_role", "last_role"))

        def close() -> None:
            nonlocal seq, size
            out.append({"conv_id": now, "seq": seq, "symbols": "".join(symbols), **counts, **ends})
            seq += 1
            symbols.clear()
            size = 0
            counts.update(dict.fromkeys(counts, 0))
            ends.update(dict.fromkeys(ends))

        def add(role: str, turn: int | None, symbol: str, times: int) -> None:
            """`times` neighbouring rows of one symbol."""
            nonlocal size
            while times:
                if size == most:
                    close()
                took = min(times, most - size)
                if ends["last_role"] is not None:
                    counts["illegal"] += ends["last_role"] + role not in LEGAL
                counts["illegal"] += (took - 1) * (role + role not in LEGAL)
                ends["first_role"] = ends["first_role"] or role
                ends["last_role"] = role
                if turn is not None:
                    counts["turns"] += ends["last_turn"] != turn
                    ends["first_turn"] = turn if ends["first_turn"] is None else ends["first_turn"]
                    ends["last_turn"] = turn
                symbols.append(symbol * took)
                size += took
                times -= took

        for batch in batches:
            for conv, turn, role, blank, cut, copies, first in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if conv != now or now is _blocks:
                    if now is not _blocks:
                        close()
                    now = conv
                if not copies:
                    continue
                if blank:
                    add(role, turn, "x", copies)
                    counts["blank"] += copies
                    continue
                if first:
                    add(role, turn, role.upper() if cut else role, 1)
                    counts["truncated"] += bool(cut)
                    copies -= 1
                if copies:
                    add(role, turn, "x", copies)
                    counts["duplicate"] += copies
            if len(out) >= 20_000:
                yield pa.RecordBatch.from_pylist(out, schema=_BLOCK_ARROW)
                out = []
        if now is not _blocks:
            close()
        yield pa.RecordBatch.from_pylist(out, schema=_BLOCK_ARROW)

    return run


# --- grammar ---------------------------------------------------------------------------------------


def _substituted(symbols: str, levels: list[dict[str, str]], patterns: list[re.Pattern]) -> str:
    for rules, pattern in zip(levels, patterns, strict=True):
        symbols = pattern.sub(lambda m, rules=rules: rules[m.group()], symbols)
    return symbols


def _patterns(levels: list[dict[str, str]]) -> list[re.Pattern]:
    return [re.compile("|".join(map(re.escape, rules))) for rules in levels]


def _pair_counts(levels: list[dict[str, str]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = _patterns(levels)
        found: Counter = Counter()
        for batch in batches:
            for symbols in batch.column(0).to_pylist():
                text = _substituted(symbols, levels, patterns)
                last = None  # place of the pair counted last, where it is of one symbol twice
                for k in range(len(text) - 1):
                    pair = text[k : k + 2]
                    if pair[0] == pair[1]:
                        if last == k - 1:
                            continue  # runs are counted without overlaps
                        last = k
                    found[pair] += 1
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], names=["pair", "n"])

    return run


def _apart(pairs: list[str], most: int) -> list[str]:
    """Pairs in order of frequency, without those that could overlap one taken before."""
    lefts, rights, taken = set(), set(), []
    for pair in pairs:
        a, b = pair
        if a in rights or b in lefts or (a == b and a in lefts) or len(taken) == most:
            continue
        taken.append(pair)
        lefts.add(a), rights.add(b)
        if a == b:
            lefts.add(b), rights.add(a)
    return taken


def grammar(blocks: DataFrame, levels: int = LEVELS, pairs: int = PAIRS) -> list[dict[str, str]]:
    """Rules by round: pair of symbols to the symbol that stands for it; at most levels * pairs of them."""
    classes = written(blocks.select("symbols").filter("length(symbols) > 1").distinct())
    found: list[dict[str, str]] = []
    code = _FIRST_RULE
    for _ in range(levels):
        counts = classes.mapInArrow(_pair_counts(found), "pair string, n long").groupBy("pair").agg(F.sum("n").alias("n"))
        often = [r.pair for r in counts.filter("n > 1").orderBy(F.desc("n"), "pair").limit(4 * pairs).collect()]
        if not often:
            break
        taken = _apart(often, pairs)
        found.append({pair: chr(code + k) for k, pair in enumerate(taken)})
        code += len(taken)
    return found


# --- transfer matrices -----------------------------------------------------------------------------


class Rope:
    """A string in parts: short ones are flat, long ones share their parts."""

    __slots__ = ("flat", "left", "right", "size")

    def __init__(self, flat: str | None = "", left: Rope | None = None, right: Rope | None = None):
        self.flat, self.left, self.right = flat, left, right
        self.size = len(flat) if flat is not None else left.size + right.size

    def __add__(self, other: Rope) -> Rope:
        if not self.size:
            return other
        if not other.size:
            return self
        if self.size + other.size <= _FLAT:
            return Rope(self.flat + other.flat)
        return Rope(None, self, other)

    def leaves(self) -> Iterator[str]:
        todo = [self]
        while todo:
            rope = todo.pop()
            if rope.flat is not None:
                yield rope.flat
            else:
                todo += (rope.right, rope.left)

    def __str__(self) -> str:
        return self.flat if self.flat is not None else "".join(self.leaves())

    def __lt__(self, other: Rope) -> bool:
        if self is other:
            return False
        if self.flat is not None and other.flat is not None:
            return self.flat < other.flat
        mine, its = self.leaves(), other.leaves()
        a = b = ""
        while True:
            a, b = a or next(mine, ""), b or next(its, "")
            if not a or not b:
                return not a and bool(b)
            size = min(len(a), len(b))
            if a[:size] != b[:size]:
                return a[:size] < b[:size]
            a, b = a[size:], b[size:]


# A matrix is {(from, to): (cost, audit)} over the states 0 nothing yet, 1 after s, 2 after u, 3 after a; absent cells are impossible.
Cell = tuple[int, Rope]
Matrix = dict[tuple[int, int], Cell]
_NEXT = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
_GIVEN = {0: "u", 1: "u", 2: "a", 3: "u"}  # role that an insertion or a new role has after a state


def _less(a: Cell, b: Cell) -> bool:
    return a[0] < b[0] or (a[0] == b[0] and a[1] < b[1])


def _better(cells: Matrix, place: tuple[int, int], cell: Cell) -> None:
    if place not in cells or _less(cell, cells[place]):
        cells[place] = cell


def times(x: Matrix, y: Matrix) -> Matrix:
    """Min-plus product: costs add, audits follow one another, the least of each cell stays."""
    out: Matrix = {}
    for (i, k), (cost, audit) in x.items():
        for j in range(4):
            step = y.get((k, j))
            if step is not None:
                total = cost + step[0]
                seen = out.get((i, j))
                if seen is None or total <= seen[0]:
                    _better(out, (i, j), (total, audit + step[1]))
    return out


def _insertions() -> Matrix:
    """Any number of insertions; more than two only lead back."""
    out: Matrix = {(k, k): (0, Rope()) for k in range(4)}
    for start in range(4):
        state, cost, audit = start, 0, ""
        for _ in range(2):
            state, cost, audit = _NEXT[state][_GIVEN[state]], cost + INSERT, audit + "I"
            _better(out, (start, state), (cost, Rope(audit)))
    return out


def terminal(symbol: str) -> Matrix:
    """Insertions before a row, then its edit."""
    edit: Matrix = {(k, k): (DELETE, Rope("D")) for k in range(4)}
    if symbol != "x":
        stays = TRUNCATED if symbol.isupper() else 0
        for state, moves in _NEXT.items():
            if symbol.lower() in moves:
                _better(edit, (state, moves[symbol.lower()]), (KEEP + stays, Rope("K")))
            _better(edit, (state, moves[_GIVEN[state]]), (REROLE + stays, Rope("R")))
    return times(_insertions(), edit)


def rule_matrices(levels: list[dict[str, str]]) -> dict[str, Matrix]:
    """Matrix of every terminal and, bottom-up, of every rule."""
    found = {symbol: terminal(symbol) for symbol in "suaoSUAOx"}
    for rules in levels:
        for pair, symbol in rules.items():
            found[symbol] = times(found[pair[0]], found[pair[1]])
    return found


def finished(row: dict[int, Cell]) -> Cell:
    """Cheapest end of the pattern, with insertions at the end."""
    ends = times({(0, k): cell for k, cell in row.items()}, _insertions())
    return min((ends[0, k] for k in (0, 3) if (0, k) in ends), key=_Ordered)


class _Ordered:
    def __init__(self, cell: Cell):
        self.cell = cell

    def __lt__(self, other: _Ordered) -> bool:
        return _less(self.cell, other.cell)


class Chain:
    """Cells from state 0 over the blocks of one conversation; products of whole blocks are kept for others like them."""

    def __init__(self, levels: list[dict[str, str]], matrices: dict[str, Matrix], most: int = 5_000):
        self.levels, self.matrices, self.patterns = levels, matrices, _patterns(levels)
        self.seen: dict[str, dict[int, Cell]] = {}
        self.most = most

    def start(self) -> dict[int, Cell]:
        return {0: (0, Rope())}

    def step(self, row: dict[int, Cell], symbols: str) -> dict[int, Cell]:
        fresh = len(row) == 1 and 0 in row and not row[0][0]
        if fresh and symbols in self.seen:
            return self.seen[symbols]
        cells: Matrix = {(0, k): cell for k, cell in row.items()}
        for symbol in _substituted(symbols, self.levels, self.patterns):
            cells = times(cells, self.matrices[symbol])
        out = {k: cell for (_, k), cell in cells.items()}
        if fresh:
            if len(self.seen) >= self.most:
                self.seen.clear()
            self.seen[symbols] = out
        return out


# --- rows in order ---------------------------------------------------------------------------------

_SUMMARY_FIELDS = [("conv_id", pa.int64())] + [(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")] + [("audit", pa.string()), ("repaired_sha256", pa.string())]
_SUMMARY_ARROW = pa.schema(_SUMMARY_FIELDS)
_SUMMARY = ", ".join(f"{n} {'string' if t == pa.string() else 'long'}" for n, t in _SUMMARY_FIELDS)
_TURNS_ARROW = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("edit", pa.string())])
_TURNS = "conv_id long, place long, role string, text string, edit string"
_NAMES = {"u": "user", "a": "assistant"}


def _repaired(levels: list[dict[str, str]], matrices: dict[str, Matrix], turns: bool):
    """Per conversation its blocks, then its rows: a summary row, or the turns after repair."""
    schema = _TURNS_ARROW if turns else _SUMMARY_ARROW

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        chain = Chain(levels, matrices)
        out: list[dict] = []
        held = 0
        now: dict = {}

        def emit(role: str, text: str, edit: str) -> None:
            nonlocal held
            if turns:
                out.append({"conv_id": now["conv_id"], "place": now["place"], "role": role, "text": text, "edit": edit})
                held += len(text)
            else:
                now["hash"].update(f"{'' if not now['place'] else chr(10)}{role}:{text}".encode())
            now["place"] += 1

        def insert() -> None:
            while now["at"] < len(now["audit"]) and now["audit"][now["at"]] == "I":
                given = _GIVEN[now["state"]]
                now["state"] = _NEXT[now["state"]][given]
                emit(_NAMES[given], "", "I")
                now["at"] += 1

        def sealed() -> None:
            """All blocks are there: the audit is settled."""
            cost, audit = finished(now["row"])
            now.update(cost=cost, audit=str(audit), at=0, state=0, place=0, hash=hashlib.sha256())

        def apply(role: str, text: str | None) -> None:
            insert()
            letter = now["audit"][now["at"]]
            now["at"] += 1
            if letter == "D":
                return
            if letter == "R":
                given = _GIVEN[now["state"]]
                role = _NAMES[given]
            else:
                given = role[:1]
            now["state"] = _NEXT[now["state"]][given]
            emit(role, text, letter)

        def close() -> None:
            if not now:
                return
            if "audit" not in now:
                sealed()
            insert()
            if not turns:
                gaps = now["last"] - now["first"] + 1 - now["turns"] if now["first"] is not None else 0
                out.append({c: now[c] for c in ("conv_id", "blank", "duplicate", "truncated", "illegal", "cost", "audit")} | {"gaps": gaps, "repaired_sha256": now["hash"].hexdigest()})

        for batch in batches:
            for r in batch.to_pylist():
                if r["kind"] == 0:
                    if not now or now["conv_id"] != r["conv_id"]:
                        close()
                        now = {"conv_id": r["conv_id"], "row": chain.start(), "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "turns": 0, "first": None, "last": None, "role": None}
                    now["row"] = chain.step(now["row"], r["symbols"])
                    for c in ("blank", "duplicate", "truncated", "illegal", "turns"):
                        now[c] += r[c]
                    if r["first_role"] is not None:
                        if now["role"] is not None:
                            now["illegal"] += now["role"] + r["first_role"] not in LEGAL
                        now["role"] = r["last_role"]
                    if r["first_turn"] is not None:
                        now["turns"] -= now["last"] == r["first_turn"]
                        now["first"] = r["first_turn"] if now["first"] is None else now["first"]
                        now["last"] = r["last_turn"]
                    continue
                if "audit" not in now:
                    sealed()
                for _ in range(r["copies"]):
                    apply(r["role"], r["text"])
            if len(out) >= 5_000 or held > 8_000_000:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
                out, held = [], 0
        close()
        yield pa.RecordBatch.from_pylist(out, schema=schema)

    return run


def repair(rows: DataFrame, turns: bool = False, block: int = BLOCK, levels: int = LEVELS, pairs: int = PAIRS) -> DataFrame:
    """One row per conversation (conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256), or, with
    `turns`, one per turn after repair (conv_id, place, role, text, edit).

    rows: conv_id, turn, role, text and, optionally, copies: how often the row stands there; 0 names a conversation only.
    """
    spark = rows.sparkSession
    folder = shared_folder(spark)
    prepared = _prepared(rows)
    thin = written(marked(prepared), folder, "thin")
    shown = ("conv_id", "turn", _initial(F.col("role")).alias("role"), "blank", "cut", "copies", "first")
    ordered = _with_first(thin).repartitionByRange(*_ORDER).sortWithinPartitions(*_ORDER).select(*shown)
    blocks = written(ordered.mapInArrow(_blocks(block), _BLOCK), folder, "blocks")
    rules = grammar(blocks, levels, pairs)
    matrices = rule_matrices(rules)
    heads = blocks.withColumn("kind", F.lit(0))
    blank = F.rtrim(F.col("text"), F.lit(SPACE)) == ""
    texts = prepared.filter("copies > 0").withColumn("text", F.when(~blank, F.col("text"))).withColumn("kind", F.lit(1))
    both = heads.unionByName(texts, allowMissingColumns=True)
    stream = both.repartition("conv_id").sortWithinPartitions("conv_id", "kind", "seq", "turn", "role", "digest")
    sent = stream.drop("seq", "turn", "digest")
    out = written(sent.mapInArrow(_repaired(rules, matrices, turns), _TURNS if turns else _SUMMARY))
    remove_folder(spark, folder)
    return out
