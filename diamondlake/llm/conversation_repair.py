"""Repair of conversation structure by an auction shortest-path algorithm.

A conversation's rows and the role pattern ``(s?(ua)+)?`` span a lattice: node
(i, q) has read i rows and written roles that end in state q; arcs keep,
rerole or delete the next row or insert an empty one, at integer costs. The
auction keeps a path from the origin and a price at every node, at most the
node's distance. At the path's end it either extends the path over a tight
arc (price equal to arc cost plus the next node's price) or raises the price
to the best arc and contracts the path by a node. When the path reaches the
destination, the prices on it have converged to distances. The cheapest
repairs are then the paths over tight arcs between converged nodes; the
lexicographically least label leads from node to node.

Long conversations are solved in blocks of rows from the end, each with the
converged prices of the block behind it, so the work is linear in the rows.

In Spark, a first shuffle carries what the lattice needs of each row, not its
text; a second one brings texts, in order and behind their conversation's
edits, past an iterator that only holds a running hash. So no conversation's
texts are ever gathered, however long it is."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpoint, prepare

#: Rows of a block of the lattice.
BLOCK = 16
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: States: nothing written, after a system row, after a user row, after an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state behind a written user or assistant row, which each state allows one of.
NEXT = (USER, USER, ASSISTANT, USER)
NAMES = {USER: "user", ASSISTANT: "assistant"}
#: Codes of a row: initial of its role, by its state, plus 4 if truncated; MUST_GO for blank rows and duplicates.
INITIALS = "?sua"
MUST_GO, DROPPED = 8, 9
#: Distance from each state behind the last row: only no row or an assistant row may come last.
FINAL = (0, 2 * INSERT, INSERT, 0)


def least_cost(code: int) -> int:
    """A row's cost whatever comes before and after it: a bound for the first prices."""
    return DELETE if code == MUST_GO else TRUNCATED if code & 4 else 0


def arcs(code: int | None, state: int) -> list[tuple[str, int, int, int]]:
    """Arcs (label, cost, rows read, next state) in the order of their labels; ``code`` is None behind the last row."""
    out = [] if code is None else [("D", DELETE, 1, state)]
    out.append(("I", INSERT, 0, NEXT[state]))
    if code is not None and code != MUST_GO:
        late = TRUNCATED if code & 4 else 0
        role = code & 3
        if role and (role == NEXT[state] or role == SYSTEM and state == START):
            out.append(("K", KEEP + late, 1, role))
        out.append(("R", REROLE + late, 1, NEXT[state]))
    return out


class Lattice:
    """Prices of a block of rows, given the distances ``final`` from each state behind it."""

    def __init__(self, codes: bytes, final: tuple[int, ...]) -> None:
        self.codes, self.end = codes, len(codes)
        self.price, floor = {}, min(final)
        for q in range(4):
            self.price[self.end, q] = final[q]
        for i in range(self.end - 1, -1, -1):
            floor += least_cost(codes[i])
            for q in range(4):
                self.price[i, q] = floor
        self.converged = {(self.end, q) for q in range(4)}
        self.out = {(i, q): [(label, cost, (i + read, to)) for label, cost, read, to in arcs(codes[i], q)] for i in range(self.end) for q in range(4)}

    def auction(self, origin: tuple[int, int]) -> int:
        """Distance from ``origin``: the path is extended and contracted until it ends in a converged node."""
        path, price = [origin], self.price
        while path[-1] not in self.converged:
            node = path[-1]
            best, over = min((cost + price[to], to) for _, cost, to in self.out[node])
            if price[node] < best:
                price[node] = best                  # contraction
                if len(path) > 1:
                    path.pop()
            else:
                path.append(over)                   # extension over a tight arc
        self.converged.update(path)
        return price[origin]

    def trace(self, state: int) -> tuple[str, int]:
        """The least labels along tight arcs from the block's first row in ``state``, and the state behind them."""
        node, labels = (0, state), []
        while node[0] < self.end:
            here = self.auction(node)
            for label, cost, to in self.out[node]:
                # An arc is tight for good only where the price of its head has converged too.
                if here == cost + self.price[to] and here == cost + self.auction(to):
                    labels.append(label)
                    node = to
                    break
        return "".join(labels), node[1]


@lru_cache(maxsize=1 << 14)
def _block(codes: bytes, final: tuple[int, ...]) -> tuple[tuple[int, ...], tuple[tuple[str, int], ...]]:
    """Distances from each state before a block and the traces from there; ``final`` is relative to its least."""
    net = Lattice(codes, final)
    return tuple(net.auction((0, q)) for q in range(4)), tuple(net.trace(q) for q in range(4))


def repair(codes: bytes) -> tuple[int, str]:
    """Cost and audit (initials of the edits) of the cheapest repair of rows with these codes; of several the ASCII-least audit."""
    cuts = [codes[i:i + BLOCK] for i in range(0, len(codes), BLOCK)]
    behind, cost, finals = FINAL, 0, []
    for cut in reversed(cuts):
        finals.append(behind)
        before = _block(cut, behind)[0]
        cost += min(before)
        behind = tuple(x - min(before) for x in before)
    audit, state = [], START
    for cut, final in zip(cuts, reversed(finals), strict=True):
        labels, state = _block(cut, final)[1][state]
        audit.append(labels)
    while FINAL[state]:
        audit.append("I")
        state = NEXT[state]
    return cost + behind[START], "".join(audit)


def damage(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows (conv, turn, role, text, copy) after damage by the CRC-32 of
    ``conv_id:turn`` mod 20: 0 drops a row, 1 empties its text, 2 takes ``.!?`` out
    of it, 3 repeats it, 4 makes it a user row. Null ids, turns, roles and texts count
    as one space, in the CRC and as role and text. A dropped row stays with a null copy."""
    space = F.lit(" ")
    conv, at = F.coalesce(F.col(conv_id).cast("string"), space), F.coalesce(F.col(turn).cast("string"), space)
    kind = F.crc32(F.concat_ws(":", conv, at).cast("binary")) % 20
    said = F.coalesce(F.col(text), space)
    said = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(said, "[.!?]", "")).otherwise(said)
    copies = F.when(kind == 0, F.array(F.lit(None).cast("int"))).when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return conversations.select(F.col(conv_id).alias("conv"), F.col(turn).alias("turn"), F.when(kind == 4, "user").otherwise(F.coalesce(F.col(role), space)).alias("role"), said.alias("text"), F.explode(copies).alias("copy"))


def _order() -> list[Column]:
    return [F.asc_nulls_first("conv"), F.asc_nulls_first("turn"), F.asc("role"), F.asc("said"), F.asc("copy")]


def _edits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per conversation from rows in order; codes and a few counts are held."""
    fields = ("conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")

    def closed(conv, codes: bytearray, roles: list, faults: list, turns: list) -> tuple:
        cost, audit = repair(bytes(codes))
        gaps = turns[1] - turns[0] + 1 - turns[2] if turns else 0
        return conv, gaps, *faults, roles[0], cost, audit

    conv, state, done = None, None, []
    for b in batches:
        for key, turn, fault, role in zip(_plain(b["conv"]), _plain(b["turn"]), b["fault"].tolist(), b["initial"].tolist(), strict=True):
            if state is None or key != conv:
                if state is not None:
                    done.append(closed(conv, *state))
                conv, state = key, (bytearray(), [0, None], [0, 0, 0], [])
            codes, roles, faults, turns = state
            if fault == DROPPED:
                continue
            if turn is not None:
                if not turns:
                    turns[:] = [turn, turn, 1]
                elif turn != turns[1]:
                    turns[1:] = [turn, turns[2] + 1]
            if fault:
                faults[fault - 1] += 1
            if roles[1] is not None and (roles[1], role) not in ((SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)):
                roles[0] += 1
            roles[1] = role
            codes.append(MUST_GO if fault in (1, 2) else role + (4 if fault == 3 else 0))
        if done:
            yield pd.DataFrame(done, columns=fields)
            done = []
    if state is not None:
        yield pd.DataFrame([closed(conv, *state)], columns=fields)


def _plain(s: pd.Series) -> list:
    """Values with None for null, whole numbers as such."""
    if s.dtype.kind == "f":
        return [None if x != x else int(x) if float(x).is_integer() else x for x in s.tolist()]
    return [None if x is None or x is pd.NA else x for x in s.tolist()]


class Running:
    """Running SHA-256 of a repaired conversation: its rows come in order, only the hash and the edits are held."""

    def __init__(self, audit: str) -> None:
        self.edits, self.state, self.hash, self.first = iter(audit), START, hashlib.sha256(), True

    def _write(self, role: str, text: str) -> None:
        self.hash.update(f"{'' if self.first else chr(10)}{role}:{text}".encode())
        self.first = False

    def _next(self) -> str:
        """The next edit of a row, after writing what is inserted before it."""
        for edit in self.edits:
            if edit != "I":
                return edit
            self.state = NEXT[self.state]
            self._write(NAMES[self.state], "")
        return ""

    def row(self, role: str, text: str) -> None:
        edit = self._next()
        if edit == "D":
            return
        self.state = INITIALS.find(role[:1]) if edit == "K" else NEXT[self.state]
        self._write(role if edit == "K" else NAMES[self.state], text)

    def close(self) -> str:
        self._next()
        return self.hash.hexdigest()


def _hashes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The edits' row of each conversation with its hash; that row comes first, then the conversation's rows in order."""
    held, run = None, None
    for b in batches:
        done = []
        names = [c for c in b.columns if c not in ("role", "text")]
        for row in b.to_dict("records"):
            if row["audit"] is not None:
                if held is not None:
                    done.append({**held, "repaired_sha256": run.close()})
                held, run = {c: row[c] for c in names}, Running(row["audit"])
            else:
                run.row(row["role"], row["text"])
        if done:
            yield pd.DataFrame(done)
    if held is not None:
        yield pd.DataFrame([{**held, "repaired_sha256": run.close()}])


def repair_all(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``rows`` (conv, turn, role, text, copy; null copies are
    dropped rows): conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
    spark = prepare(rows.sparkSession)
    word = F.regexp_replace(F.col("text"), "[\\x20\\x09-\\x0D]+$", "")
    rows = rows.withColumn("said", F.md5(F.col("text").cast("binary")))
    initial = F.when(F.col("role").startswith("s"), SYSTEM).when(F.col("role").startswith("u"), USER).when(F.col("role").startswith("a"), ASSISTANT).otherwise(0)
    end = F.right(word, F.lit(1))
    shape = F.when(word == "", 1).when(end.isin(".", "!", "?"), 0).otherwise(3)
    narrow = rows.select("conv", "turn", "role", "said", "copy", initial.alias("initial"), shape.alias("shape")).repartition("conv")
    # Nothing but the order of equal rows matters to the number, and conversations are together already.
    seen = F.row_number().over(Window.partitionBy("conv", "role", "said", F.col("copy").isNull()).orderBy(F.asc_nulls_first("turn"), "copy")) > 1
    fault = F.when(F.col("copy").isNull(), DROPPED).when(F.col("shape") == 1, 1).when(seen, 2).otherwise(F.col("shape"))
    coded = narrow.withColumn("fault", fault).sortWithinPartitions(*_order()).select("conv", "turn", "fault", "initial")
    kind = rows.schema["conv"].dataType.simpleString()
    edits = checkpoint(coded.mapInPandas(_edits, f"conv {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"))
    # Each conversation's edits, then its rows: the hash runs over them in order.
    texts = rows.where(F.col("copy").isNotNull()).select("conv", "turn", "role", "said", "copy", "text")
    both = edits.withColumn("said", F.lit(None).cast("string")).unionByName(texts, allowMissingColumns=True).repartition("conv")
    both = both.sortWithinPartitions(F.asc_nulls_first("conv"), F.desc_nulls_last("audit"), *_order()[1:]).select(*edits.columns, "role", "text")
    return both.mapInPandas(_hashes, f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in edits.schema)}, repaired_sha256 string")
