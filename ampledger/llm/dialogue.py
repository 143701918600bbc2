"""Repair of conversations: a generalised LR parser over the roles, with weighted edits.

The order of roles is a grammar; its LR(0) automaton is built here. Stacks of
the parser are chains of shared nodes (state, node below), so that equal stacks
are one node, and several stacks that the rows so far allow are alive at a time. A row
is shifted as it is (keep), shifted as another role (rerole), or passed over
(delete); a role without a row can be shifted too (insert). Reductions
are tried on all stacks. Where two ways end in the same stack top, the smaller (cost,
audit) stays, audit being the initials of the edits.

Audits are not carried along: among the ways alive after a row none is a proper prefix of
another, so their order is kept as ranks, and edits are read back along ranks.
What is alive, with costs counted from the smallest, takes few different forms;
a step from one of them by one kind of row is looked up after its first use.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Fixed values of the contract: the grammar of role initials (a left side may have several rules), the roles that an
#: edit may give, and the costs.
RULES = (("C", ""), ("C", "P"), ("C", "sP"), ("P", "ua"), ("P", "Pua"))
GIVEN = {"u": "user", "a": "assistant"}
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: A stack that costs more than this above another one cannot win: the other goes on in the same way after two inserts at
#: most, and the deletion of one row (a system row behind others).
REACH = 2 * INSERT + DELETE
#: Fixed values of the contract: neighbours' initials that are in order, and the white space that makes no text.
LEGAL = frozenset(("su", "ua", "au"))
BLANKS = " \t\n\x0b\x0c\r"
#: Kinds of rows: the initial, and whether the row must go or is truncated.
GOES, CUT = "!", "~"
#: Steps that a worker remembers; beyond, it starts anew.
MEMORY = 200_000
#: Conversations in a batch of results.
BATCH = 2_000


class RoleParser:
    """Cheapest edits that bring a sequence of roles into the grammar.

    Upper-case letters are symbols of the grammar, others are role initials.
    The first rule's left side is the start. Rules must be left-recursive, so
    that stacks stay short.
    """

    def __init__(self, rules: tuple[tuple[str, str], ...] = RULES, given: dict[str, str] = GIVEN):
        self.rules, self.given = [*rules, ("", rules[0][0])], "".join(sorted(given))
        self.states: dict[frozenset, int] = {}
        self.goto: list[dict[str, int]] = []
        self.complete: list[list[int]] = []
        self._state(frozenset([(len(self.rules) - 1, 0)]))
        self.nodes: list[tuple[int, int]] = []
        self.node_at: dict[tuple[int, int], int] = {}
        self.shifted: dict[tuple[int, str], tuple[int, ...]] = {}
        bottom = self._node(0, -1)
        self.accepting = self._node(self.goto[0][rules[0][0]], bottom)
        # What is alive: (node, cost above the smallest, rank of its audit), as a tuple; the audits of one rank are equal.
        self.forms: list[tuple] = []
        self.form_at: dict[tuple, int] = {}
        self.steps: dict[tuple[int, str], tuple[int, int, tuple]] = {}
        self.start = self._form(tuple((n, 0, 0) for n in self._reduced(bottom)))

    def _state(self, kernel: frozenset) -> int:
        items, new = set(kernel), list(kernel)
        while new:
            rule, dot = new.pop()
            ahead = self.rules[rule][1][dot : dot + 1]
            for k, (left, _) in enumerate(self.rules):
                if left == ahead and ahead and (k, 0) not in items:
                    items.add((k, 0))
                    new.append((k, 0))
        if (known := frozenset(items)) in self.states:
            return self.states[known]
        number = self.states[known] = len(self.goto)
        self.goto.append({})
        self.complete.append([r for r, dot in items if dot == len(self.rules[r][1]) and self.rules[r][0]])
        for symbol in sorted({self.rules[r][1][dot] for r, dot in items if dot < len(self.rules[r][1])}):
            moved = frozenset((r, dot + 1) for r, dot in items if self.rules[r][1][dot : dot + 1] == symbol)
            self.goto[number][symbol] = self._state(moved)
        return number

    def _node(self, state: int, below: int) -> int:
        if (state, below) not in self.node_at:
            self.node_at[state, below] = len(self.nodes)
            self.nodes.append((state, below))
        return self.node_at[state, below]

    def _reduced(self, node: int) -> tuple[int, ...]:
        """The stack, and all that reductions make of it."""
        out, new = {node}, [node]
        while new:
            top = new.pop()
            for rule in self.complete[self.nodes[top][0]]:
                left, right = self.rules[rule]
                below = top
                for _ in right:
                    below = self.nodes[below][1]
                made = self._node(self.goto[self.nodes[below][0]][left], below)
                if made not in out:
                    out.add(made)
                    new.append(made)
        return tuple(sorted(out))

    def _shift(self, node: int, role: str) -> tuple[int, ...]:
        if (node, role) not in self.shifted:
            state = self.goto[self.nodes[node][0]].get(role)
            self.shifted[node, role] = () if state is None else self._reduced(self._node(state, node))
        return self.shifted[node, role]

    def _form(self, form: tuple) -> int:
        if form not in self.form_at:
            self.form_at[form] = len(self.forms)
            self.forms.append(form)
        return self.form_at[form]

    def _inserted(self, form: int) -> dict[int, tuple[int, int, str]]:
        """Least (cost, rank, edits since) of each stack after any inserts."""
        best = {n: (cost, rank, "") for n, cost, rank in self.forms[form]}
        new = list(best)
        while new:
            node = new.pop()
            cost, rank, edits = best[node]
            for role in self.given:
                for made in self._shift(node, role):
                    way = (cost + INSERT, rank, edits + "I")
                    if made not in best or way < best[made]:
                        best[made] = way
                        new.append(made)
        return best

    def _step(self, form: int, kind: str) -> tuple[int, int, tuple]:
        """The form after a row of this kind, the cost that is added for sure, and (rank before, edits) by new rank."""
        best: dict[int, tuple[int, int, str]] = {}
        for node, (cost, rank, edits) in self._inserted(form).items():
            ways = [(DELETE, "D", (node,))]
            if GOES not in kind:
                more = TRUNCATED if CUT in kind else 0
                ways += [(more, "K", self._shift(node, kind[0]))] + [(REROLE + more, "R", self._shift(node, r)) for r in self.given]
            for price, edit, made in ways:
                way = (cost + price, rank, edits + edit)
                for n in made:
                    if n not in best or way < best[n]:
                        best[n] = way
        least = min(way[0] for way in best.values())
        best = {n: way for n, way in best.items() if way[0] <= least + REACH}
        back = sorted({way[1:] for way in best.values()})
        place = {edits: i for i, edits in enumerate(back)}
        form = self._form(tuple(sorted((n, way[0] - least, place[way[1:]]) for n, way in best.items())))
        return form, least, tuple(back)

    def repair(self, kinds: list[str]) -> tuple[int, str]:
        """Cost and audit of the cheapest edits; of equally cheap ones those with the least audit."""
        if len(self.steps) > MEMORY:
            self.steps.clear()
        form, total, trail = self.start, 0, []
        for kind in kinds:
            if (form, kind) not in self.steps:
                self.steps[form, kind] = self._step(form, kind)
            form, cost, back = self.steps[form, kind]
            total += cost
            trail.append(back)
        cost, rank, edits = self._inserted(form)[self.accepting]
        parts = [edits]
        for back in reversed(trail):
            rank, edits = back[rank]
            parts.append(edits)
        return total + cost, "".join(reversed(parts))


def repaired_rows(audit: str, roles: list[str], texts: list[str], given: dict[str, str] = GIVEN) -> list[tuple[str, str]]:
    """Roles and texts after the edits: a given role is the one that the turn-taking asks for."""
    out: list[tuple[str, str]] = []
    row = 0
    for edit in audit:
        turn = given["a" if out and out[-1][0][:1] == "u" else "u"]
        if edit == "I":
            out.append((turn, ""))
            continue
        if edit != "D":
            out.append((turn if edit == "R" else roles[row], texts[row]))
        row += 1
    return out


def repair_conversations(
    rows: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    present: Column | None = None,
) -> DataFrame:
    """One row per conversation: its id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired.

    Rows of a conversation are taken by turn, nulls first, then by role and
    text. Each row's first fault counts: blank (nothing but ASCII white space),
    duplicate (role and text of an earlier row), truncated (the last character
    that isn't white space is none of ``.!?``). ``gaps`` are the turns that
    lack between the smallest and the greatest, ``illegal`` the neighbours
    whose role initials are none of su, ua, au. ``cost`` and ``audit`` are
    those of the cheapest edits (K keep, R rerole, D delete, I insert) to a
    conversation of the form (s?(ua)+)?, ``repaired`` its roles and texts.

    Null roles and texts are one space; rows with a null id are one
    conversation. Rows for which ``present`` isn't true only name their
    conversation: one without other rows has zeros and an empty audit.
    Repeated rows are duplicates. An empty table gives no rows; other columns
    are ignored.

    One shuffle, by conversation. A task reads the sorted rows as a stream and
    holds one conversation at a time, since its repaired text is one value; its duplicates are told
    by a window before.
    """
    kind, order = (rows.schema[c].dataType.simpleString() for c in (conv_col, turn_col))
    if order not in ("tinyint", "smallint", "int", "bigint"):
        raise TypeError(f"turns must be integers, not {order}")
    columns = rows.select(
        F.col(conv_col).alias("conv"),
        F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text_col), F.lit(" ")).alias("text"),
        F.coalesce(F.lit(True) if present is None else present, F.lit(False)).alias("here"),
    )
    end = F.rtrim("text", F.lit(BLANKS))
    hashed = columns.repartition("conv").withColumns(
        {"h1": F.xxhash64("here", "role", "text"), "h2": F.xxhash64(F.lit(1), "text", "role", "here"), "end": F.when(end == "", "").otherwise(F.substring(end, -1, 1))}
    )
    earlier = F.row_number().over(Window.partitionBy("conv", "h1", "h2").orderBy(F.col("turn").asc_nulls_first())) > 1
    fault = F.when(F.col("end") == "", "blank").when(earlier, "duplicate").when(~F.col("end").isin(".", "!", "?"), "truncated").otherwise("")
    told = hashed.select("conv", "turn", "role", "text", "here", fault.alias("fault"))
    told = told.sortWithinPartitions("conv", F.col("turn").asc_nulls_first(), "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = RoleParser()
        done: list[tuple] = []
        current: _Conversation | None = None
        for batch in batches:
            conv = batch.column(0)
            for key, *row in zip(conv.to_pylist(), *(batch.column(i).to_pylist() for i in range(1, 6))):
                if current is None or key != current.key:
                    if current is not None:
                        done.append(current.result(parser))
                    current = _Conversation(key)
                current.add(*row)
            if len(done) >= BATCH:
                yield _results(done, conv_col, conv.type)
                done = []
            last = conv.type
        if current is not None:
            done.append(current.result(parser))
            yield _results(done, conv_col, last)

    schema = f"`{conv_col}` {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired array<struct<role:string,text:string>>"
    return told.mapInArrow(run, schema)


class _Conversation:
    """The rows of one conversation, in order."""

    def __init__(self, key):
        self.key = key
        self.least = self.most = self.before = None
        self.turns = 0
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0, "": 0}
        self.kinds: list[str] = []
        self.roles: list[str] = []
        self.texts: list[str] = []

    def add(self, turn: int | None, role: str, text: str, here: bool, fault: str) -> None:
        if not here:
            return
        if turn is not None:
            self.least = turn if self.least is None else self.least
            self.turns += turn != self.most
            self.most = turn
        self.faults[fault] += 1
        first = role[:1] if role[:1] in ("s", "u", "a") else "?"
        self.kinds.append(GOES if fault in ("blank", "duplicate") else first + CUT if fault else first)
        self.roles.append(role)
        self.texts.append(text)

    def result(self, parser: RoleParser) -> tuple:
        cost, audit = parser.repair(self.kinds)
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.turns
        illegal = sum(a[:1] + b[:1] not in LEGAL for a, b in zip(self.roles, self.roles[1:]))
        counts = [gaps, *(self.faults[f] for f in ("blank", "duplicate", "truncated")), illegal, cost]
        return self.key, *counts, audit, repaired_rows(audit, self.roles, self.texts)


def _results(done: list[tuple], conv_col: str, kind: pa.DataType) -> pa.RecordBatch:
    columns = list(zip(*done))
    rows = [[{"role": r, "text": t} for r, t in c] for c in columns[8]]
    pair = pa.struct([("role", pa.string()), ("text", pa.string())])
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[0], kind), *(pa.array(c, pa.int64()) for c in columns[1:7]), pa.array(columns[7], pa.string()), pa.array(rows, pa.list_(pair))],
        [conv_col, "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired"],
    )


def damage(rows: DataFrame) -> DataFrame:
    """Conversations with planted faults, chosen by the checksum of id and turn; ``here`` is false for rows left out.

    Of 20 remainders of the CRC-32 of ``conv_id:turn``, 0 leaves the row out, 1
    empties its text, 2 takes ``.!?`` out, 3 repeats the row, 4 makes it the
    user's. Nulls are one space.
    """
    filled = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")}
    chosen = F.crc32(F.concat(filled["conv_id"], F.lit(":"), filled["turn"]).cast("binary")) % 20
    text = F.when(chosen <= 1, "").when(chosen == 2, F.translate(filled["text"], ".!?", "")).otherwise(filled["text"])
    role = F.when(chosen == 4, "user").otherwise(filled["role"])
    return rows.select(
        "conv_id",
        "turn",
        role.alias("role"),
        text.alias("text"),
        (chosen != 0).alias("here"),
        F.explode(F.sequence(F.lit(1), F.when(chosen == 3, 2).otherwise(1))).alias("copy"),
    ).drop("copy")
