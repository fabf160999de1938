"""Repair of conversations: the cheapest edits that give system?, then user and assistant in turn.

Rows of a conversation and the states of the grammar (nothing yet, after system, after user, after assistant)
span a lattice. Keep, rerole, delete and insert are its edges; ``Lattice.cheapest`` runs Dijkstra from both ends, a
heap forward and a heap in reverse, until no path can be as cheap as the best crossing of the two, looks at
every crossing of that cost and takes the least audit (initials of the edits in order). Among paths of one cost
between two nodes no audit is the beginning of another, as only dearer inserts could follow; so the least audit
of a path is made of the least audits of its parts.

Rows are dealt out by ranges of (conversation, turn, role, text's hash) and sorted, so a conversation with a
third of all rows is spread over many tasks. A task repairs the conversations that lie within its range. One
that touches the end of a range, or has more than ``HELD`` rows, is a part: the cheapest ways between every two
states for its rows, and the rows in chunks. Parts are put together by conversation, a small row each, and the
chunks are hashed in order, streamed through one task a conversation (a hash is sequential).

Defined results: null role and text count as one space. Rows stand by turn (nulls first), then by role and
hash of the text. A row is blank without a character other than ASCII blanks, duplicate if an earlier row has
its role and text, truncated if its last such character isn't one of ``.!?``; the first fault counts. Roles
are told by their first character. Extra columns take no part. A conversation whose rows are all marked
``dropped`` (or an empty one) has zeros, an empty audit and the hash of the empty string. Gaps of more than a
long holds count as the largest long.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from heapq import heappop, heappush

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fulltime.llm.common import fanout, map_arrow, slices, stored

#: Rows of a conversation that a task holds at once.
HELD = 512
BLANKS = " \t\n\x0b\x0c\r"
#: Cost of each edit, and of leaving a truncated row in.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: States: nothing yet, after system, user, assistant. What may follow, and the states a conversation may end in.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = [{"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER}]
ENDS = (START, ASSISTANT)
NAMES = {"u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}
#: Faults of a row.
CLEAN, BLANK, DUPLICATE, CUT = range(4)

Row = tuple[str, int]  # initial of the role, fault
Way = tuple[int, str]  # cost, audit


def _edges(rows: list[Row], i: int, q: int) -> Iterator[tuple[int, str, int, int]]:
    """(cost, edit, row, state) of the edges out of a node."""
    for initial, to in NEXT[q].items():
        if initial != "s":
            yield INSERT, "I", i, to
    if i < len(rows):
        initial, fault = rows[i]
        yield DELETE, "D", i + 1, q
        if fault in (CLEAN, CUT):
            more = TRUNCATED if fault == CUT else 0
            if initial in NEXT[q]:
                yield more, "K", i + 1, NEXT[q][initial]
            for name, to in NEXT[q].items():
                if name != "s" and name != initial:
                    yield REROLE + more, "R", i + 1, to


class Lattice:
    """The edges out of and into every node (row, state)."""

    def __init__(self, rows: list[Row]):
        self.n = len(rows)
        self.out = {(i, q): [*_edges(rows, i, q)] for i in range(self.n + 1) for q in range(4)}
        self.into: dict = {node: [] for node in self.out}
        for (i, q), edges in self.out.items():
            for cost, edit, j, p in edges:
                self.into[j, p].append((cost, edit, i, q))

    def cheapest(self, start: int = START, ends: tuple[int, ...] = ENDS) -> Way | None:
        """Least cost and, among its paths, the least audit from a state before the rows to one of some after them."""
        # heap entries: cost, rows done (free edges always add one), audit, row, state
        heaps = ([(0, 0, "", 0, start)], [(0, 0, "", self.n, q) for q in ends])
        done: tuple[dict, dict] = ({}, {})
        best: Way | None = None
        while heaps[0] and heaps[1]:
            if best is not None and heaps[0][0][0] + heaps[1][0][0] > best[0]:
                break
            side = 0 if heaps[0][0][0] <= heaps[1][0][0] else 1
            cost, rank, audit, i, q = heappop(heaps[side])
            own, other = done[side], done[1 - side]
            if (i, q) in own:
                continue
            own[i, q] = cost, audit
            crossings = [(0, "", i, q), *(self.into if side else self.out)[i, q]]
            for w, edit, j, p in crossings:
                if (j, p) in other:
                    c, a = other[j, p]
                    way = cost + w + c, (a + edit + audit if side else audit + edit + a)
                    best = way if best is None else min(best, way)
                if (j, p) not in own:
                    heappush(heaps[side], (cost + w, rank + abs(j - i), edit + audit if side else audit + edit, j, p))
        return best

    def ways(self) -> list[list[Way | None]]:
        """The cheapest way from each state before the rows to each state after them."""
        return [[self.cheapest(p, (q,)) for q in range(4)] for p in range(4)]


def joined(a: list[list[Way | None]], b: list[list[Way | None]]) -> list[list[Way | None]]:
    """Ways over two parts, one after the other."""
    return [[min([(x[0] + y[0], x[1] + y[1]) for m in range(4) if (x := a[p][m]) and (y := b[m][q])], default=None)
             for q in range(4)] for p in range(4)]


class Mender:
    """Applies an audit to rows as they come: the lines of the repaired conversation."""

    def __init__(self, state: int = START):
        self.state = state

    def _named(self) -> str:
        initial = "a" if self.state == USER else "u"
        self.state = NEXT[self.state][initial]
        return NAMES[initial]

    def lines(self, audit: str, rows: list[tuple[str, str]], at: int = 0) -> tuple[list[tuple[str, str]], int]:
        """(role, text) of the lines that the audit makes of the rows from letter ``at`` on, and the letter after.

        Letters are taken while rows are left, inserts after the last row with it.
        """
        out, k = [], 0
        while at < len(audit) and (k < len(rows) or audit[at] == "I"):
            edit = audit[at]
            at += 1
            if edit == "I":
                out.append((self._named(), ""))
                continue
            role, text = rows[k]
            k += 1
            if edit == "K":
                self.state = NEXT[self.state][role[:1]]
                out.append((role, text))
            elif edit == "R":
                out.append((self._named(), text))
        return out, at


class Digest:
    """SHA-256 of lines ``role:text`` joined by newlines, as they come."""

    def __init__(self):
        self.hash, self.any = sha256(), False

    def add(self, lines: list[tuple[str, str]]) -> None:
        for role, text in lines:
            self.hash.update(f"{chr(10) if self.any else ''}{role}:{text}".encode())
            self.any = True

    def hex(self) -> str:
        return self.hash.hexdigest()


class Facts:
    """Counts of a run of rows in order: turns, faults, adjacent roles."""

    NAMES = ("n", "low", "high", "turns", "blank", "duplicate", "truncated", "illegal", "first", "last")

    def __init__(self):
        self.n = self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.low = self.high = self.first = self.last = None

    def add(self, turn: int | None, initial: str, fault: int) -> None:
        if turn is not None and turn != self.high:
            self.low, self.high, self.turns = turn if self.low is None else self.low, turn, self.turns + 1
        if self.last is not None and self.last + initial not in LEGAL:
            self.illegal += 1
        self.first, self.last = initial if self.first is None else self.first, initial
        self.n += 1
        self.blank += fault == BLANK
        self.duplicate += fault == DUPLICATE
        self.truncated += fault == CUT

    def extend(self, other: dict) -> None:
        """Counts of the rows that follow."""
        if not other["n"]:
            return
        if other["turns"]:
            self.turns += other["turns"] - (self.high is not None and self.high == other["low"])
            self.low, self.high = other["low"] if self.low is None else self.low, other["high"]
        if self.last is not None:
            self.illegal += self.last + other["first"] not in LEGAL
        self.illegal += other["illegal"]
        self.first, self.last = other["first"] if self.first is None else self.first, other["last"]
        for k in ("n", "blank", "duplicate", "truncated"):
            setattr(self, k, getattr(self, k) + other[k])

    def row(self) -> dict:
        return {k: getattr(self, k) for k in self.NAMES}

    def counts(self) -> dict:
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return {"gaps": min(gaps, 2**63 - 1), "blank": self.blank, "duplicate": self.duplicate, "truncated": self.truncated, "illegal": self.illegal}


FACTS = ("n long, low long, high long, turns long, blank long, duplicate long, truncated long, illegal long, first string, last string")
RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
PIECES = (f"conv_id long, kind string, part int, seq int, {FACTS}, gaps long, cost long, audit string, repaired_sha256 string, "
          "ways array<struct<p:int,q:int,cost:long,audit:string>>, rows array<struct<role:string,text:string>>")


def _prepared(rows: DataFrame) -> DataFrame:
    """Rows with their hash (of role and text) and whether an earlier turn has the same."""
    text = [F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")]
    rows = rows.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), *text, "dropped")
    rows = rows.withColumn("own", F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text")))
    turn = F.struct(F.col("turn").isNotNull(), F.coalesce("turn", F.lit(0)))
    # those that stand in two turns at least, mostly few: Spark sends them to the rows if they are small
    again = stored(rows.where("not dropped").groupBy("conv_id", "own").agg(F.min(turn).alias("a"), F.max(turn).alias("b"))
                   .where("a < b").select(F.col("conv_id").alias("c"), F.col("own").alias("o"), "a"), "again")
    held = rows.join(again, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("own") == F.col("o")), "left")
    return held.select("conv_id", "turn", "role", "text", "dropped", "own", F.coalesce(turn > F.col("a"), F.lit(False)).alias("earlier"))


def _pieces(rows: DataFrame) -> DataFrame:
    """Whole conversations (kind whole), parts of others (kind part) and the chunks of those (kind chunk)."""
    names = PIECES.split(", ways")[0]
    names = [f.split()[0] for f in names.split(", ")] + ["ways", "rows"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        number = TaskContext.get().partitionId()
        out: dict = {k: [] for k in names}

        def put(**row) -> None:
            for k in names:
                out[k].append(row.get(k))

        class Run:
            """The rows of one conversation in this range."""

            def __init__(self, conv: int | None, part: bool):
                self.conv, self.part, self.facts, self.rows, self.cells, self.seq, self.before, self.all = conv, part, Facts(), [], [], 0, None, None

            def add(self, turn, role, text, own, earlier) -> None:
                solid = text.strip(BLANKS)
                same = (turn, own) == self.before
                self.before = turn, own
                fault = BLANK if not solid else DUPLICATE if earlier or same else CUT if solid[-1] not in ".!?" else CLEAN
                self.facts.add(turn, role[:1], fault)
                self.rows.append((role, text))
                self.cells.append((role[:1], fault))
                if len(self.rows) >= HELD:
                    self.part = True
                    self.flush()

            def flush(self) -> None:
                if self.rows:
                    put(conv_id=self.conv, kind="chunk", part=number, seq=self.seq, rows=[{"role": r, "text": t} for r, t in self.rows])
                    own = Lattice(self.cells).ways()
                    self.all = own if self.all is None else joined(self.all, own)
                    self.rows, self.cells, self.seq = [], [], self.seq + 1

            def end(self, last: bool) -> None:
                if self.part or last:
                    self.flush()
                    flat = [{"p": p, "q": q, "cost": w[0], "audit": w[1]} for p, line in enumerate(self.all or []) for q, w in enumerate(line) if w]
                    put(conv_id=self.conv, kind="part", part=number, seq=-1, ways=flat, **self.facts.row())
                    return
                cost, audit = Lattice(self.cells).cheapest()
                digest = Digest()
                digest.add(Mender().lines(audit, self.rows)[0])
                put(conv_id=self.conv, kind="whole", cost=cost, audit=audit, repaired_sha256=digest.hex(), **self.facts.counts())

        current: Run | None = None
        for batch in slices(batches, "text"):
            for conv, turn, role, text, dropped, own, earlier in zip(*(batch.column(c).to_pylist() for c in (
                    "conv_id", "turn", "role", "text", "dropped", "own", "earlier"))):
                if current is None or conv != current.conv:
                    if current is not None:
                        current.end(False)
                    current = Run(conv, current is None)
                if not dropped:
                    current.add(turn, role, text, own, earlier)
            if out["kind"]:
                yield out
                out = {k: [] for k in names}
        if current is not None:
            current.end(True)
            yield out

    order = ["conv_id", "turn", "role", "own"]
    dealt = rows.repartitionByRange(fanout(rows.sparkSession), *order).sortWithinPartitions(*order)
    return map_arrow(dealt, run, PIECES)


def _put_together(pieces: DataFrame) -> DataFrame:
    """Results of conversations that lie in several ranges, and the audit of each part (kind audit)."""
    parts = pieces.where("kind = 'part'").select("conv_id", "part", *Facts.NAMES, "ways")
    schema = (f"conv_id long, kind string, part int, seq int, state int, {RESULT}")
    names = [f.split()[0] for f in schema.split(", ")]

    def merge(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["part"])
        facts, cells = Facts(), []
        for r in rows:
            facts.extend(r)
            if r["n"]:
                grid: list = [[None] * 4 for _ in range(4)]
                for w in r["ways"]:
                    grid[w["p"]][w["q"]] = w["cost"], w["audit"]
                cells.append((r["part"], grid))
        # least ways from the start up to each part's end, then back from the best end
        reach: list[list[Way | None]] = [[(0, ""), None, None, None]]
        for _, grid in cells:
            reach.append(joined([reach[-1]] + [[None] * 4] * 3, grid)[0])
        q = min((w, q) for q in ENDS if (w := reach[-1][q]))[1]
        cost, audit = reach[-1][q]
        out = [{"conv_id": rows[0]["conv_id"], "kind": "result", "cost": cost, "audit": audit} | facts.counts()]
        for k in range(len(cells) - 1, -1, -1):
            part, grid = cells[k]
            p = min(((x[0] + y[0], x[1] + y[1]), p) for p in range(4) if (x := reach[k][p]) and (y := grid[p][q]))[1]
            out.append({"conv_id": rows[0]["conv_id"], "kind": "audit", "part": part, "seq": -1, "state": p, "audit": grid[p][q][1]})
            q = p
        arrow = {"string": pa.string(), "int": pa.int32(), "long": pa.int64()}
        types = [arrow[f.split()[1]] for f in schema.split(", ")]
        return pa.table({n: pa.array([r.get(n) for r in out], t) for n, t in zip(names, types)})

    return parts.groupBy("conv_id").applyInArrow(merge, schema)


def _digests(pieces: DataFrame, merged: DataFrame) -> DataFrame:
    """(c, repaired_sha256) of the conversations in parts: chunks and audits in order, streamed."""
    rows = pieces.schema["rows"].dataType.simpleString()
    chunks = pieces.where("kind = 'chunk'").select("conv_id", "part", "seq", F.lit(None).cast("int").alias("state"), F.lit(None).cast("string").alias("audit"), "rows")
    audits = merged.where("kind = 'audit'").select("conv_id", "part", "seq", "state", "audit", F.lit(None).cast(rows).alias("rows"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        conv: object = run  # no conversation yet
        digest, mender, audit, at = Digest(), Mender(), "", 0
        for batch in batches:
            for c, state, text, rows in zip(*(batch.column(k) for k in ("conv_id", "state", "audit", "rows"))):
                c = c.as_py()
                if c != conv:
                    if conv is not run:
                        yield {"c": [conv], "sha": [digest.hex()]}
                    conv, digest = c, Digest()
                if rows.is_valid:
                    lines, at = mender.lines(audit, [(r["role"], r["text"]) for r in rows.as_py()], at)
                    digest.add(lines)
                else:
                    mender, audit, at = Mender(state.as_py()), text.as_py(), 0
        if conv is not run:
            yield {"c": [conv], "sha": [digest.hex()]}

    dealt = chunks.union(audits).repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq")
    return map_arrow(dealt, run, "c long, sha string")


def repair(rows: DataFrame) -> DataFrame:
    """Faults, cost, audit and hash of the repaired text of every conversation.

    ``rows`` are (conv_id, turn, role, text, dropped): rows marked dropped only say that their conversation
    exists.
    """
    pieces = stored(_pieces(_prepared(rows)), "pieces")
    merged = stored(_put_together(pieces), "merged")
    columns = [f.split()[0] for f in RESULT.split(", ")]
    whole = pieces.where("kind = 'whole'").select("conv_id", *columns)
    split = merged.where("kind = 'result'").drop("repaired_sha256").join(
        _digests(pieces, merged), F.col("conv_id").eqNullSafe(F.col("c")), "left")
    split = split.withColumn("repaired_sha256", F.coalesce("sha", F.sha2(F.lit(""), 256)))
    return whole.union(split.select("conv_id", *columns))


def damaged(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) with faults put in by a hash of conversation and turn, a twentieth each:
    marked dropped, text emptied, without ``.!?``, repeated, role set to user. Nulls in the hash are a space."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    kind = F.pmod(F.crc32(key), F.lit(20))
    held = rows.select("conv_id", "turn", "role", "text", kind.alias("kind"))
    text = (F.when(F.col("kind") <= 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")))
    times = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return held.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
                       text.alias("text"), (F.col("kind") == 0).alias("dropped"), times.alias("copy")).drop("copy")
