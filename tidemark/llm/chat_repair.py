"""Minimum-cost role repair of chats and their rendering.

A legal chat is an optional system turn, then user and assistant turns in alternation, with an assistant turn last. A
dynamic program over the automaton of the last role written chooses, for each turn, the role that it gets (relabels
cost), whether it is merged into the turn before (of the same role), and whether empty turns are inserted before it;
at the end empty turns are added as needed. Ties go to the first choice in the order of ACTIONS, then of ROLES.

Turns are sorted by conversation and place into ranges, so that a conversation of any length is dealt to several tasks.
Each part of a conversation becomes a (min, +) matrix from the role before it to the role after it; the parts' matrices,
as many as there are ranges at most, are composed to find the roles at their borders, and each part is then decoded
between its borders on its own.

Defined results: a null conversation is one conversation; unknown and null roles can take any role for `unknown`; null
texts render as empty; a marker in a text ("<|") gets a backslash inside ("<\\|", one that has some one more), so no text
opens a turn; turns with equal numbers stand in the order of role and text; repeated rows are turns of their
own; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Stored

ROLES = ("system", "user", "assistant")
#: States: nothing written yet, or the last role written (1 + its place in ROLES).
N_STATES = 4
_NEXT = {0: (1, 2), 1: (2,), 2: (3,), 3: (2,)}
ACTIONS = ("append", "merge", "insert")


@dataclass(frozen=True)
class Costs:
    relabel: int = 3
    relabel_system: int = 4  # from or to system
    unknown: int = 1
    merge: int = 1
    insert: int = 2


def _between(a: int, b: int) -> tuple[int, ...] | None:
    """The states of the empty turns that lead from state a to b, none if b may follow a."""
    if b in _NEXT[a]:
        return ()
    for x in _NEXT[a]:
        if b in _NEXT[x]:
            return (x,)
        for y in _NEXT[x]:
            if b in _NEXT[y] and y != a:
                return (x, y)
    return None


def _options(role: int, costs: Costs) -> list[list[tuple[float, int, tuple[int, ...]]]]:
    """[from state][to state]: (cost, action, inserted states) of a turn of this role (3: unknown)."""
    table = []
    for a in range(N_STATES):
        row = []
        for b in range(N_STATES):
            if b == 0:
                row.append((np.inf, 0, ()))
                continue
            paid = 0 if role == b - 1 else costs.unknown if role == 3 else costs.relabel_system if 0 in (role, b - 1) else costs.relabel
            found = []
            way = _between(a, b)
            if way == ():
                found.append((paid, 0, ()))
            if a == b:
                found.append((paid + costs.merge, 1, ()))
            if way:
                found.append((paid + costs.insert * len(way), 2, way))
            row.append(min(found, default=(np.inf, 0, ())))
        table.append(row)
    return table


class Automaton:
    def __init__(self, costs: Costs = Costs()):  # noqa: B008
        self.options = [_options(r, costs) for r in range(4)]
        self.matrices = np.array([[[x[0] for x in row] for row in table] for table in self.options])
        # empty turns after the last one, up to an assistant turn
        self.endings = [(), (2, 3), (3,), ()]
        self.end_cost = np.array([0, 2 * costs.insert, costs.insert, 0], dtype=float)

    def matrix(self, roles: bytes) -> np.ndarray:
        """The least cost from each state before the turns to each state after them."""
        total = np.where(np.eye(N_STATES, dtype=bool), 0.0, np.inf)
        for r in roles:
            total = (total[:, :, None] + self.matrices[r][None]).min(axis=1)
        return total

    def borders(self, matrices: list[np.ndarray]) -> list[int]:
        """The states before, between and after the parts, of least total cost."""
        cost, came = np.array([0.0, np.inf, np.inf, np.inf]), []
        for m in matrices:
            through = cost[:, None] + m
            came.append(through.argmin(axis=0))
            cost = through.min(axis=0)
        state = int((cost + self.end_cost).argmin())
        out = [state]
        for back in reversed(came):
            state = int(back[state])
            out.append(state)
        return out[::-1]

    def decode(self, roles: bytes, begin: int, end: int) -> list[tuple[int, int, tuple[int, ...], float]]:
        """(state, action, inserted states, cost) of each turn, from state begin to state end."""
        cost, came = np.full(N_STATES, np.inf), []
        cost[begin] = 0
        for r in roles:
            through = cost[:, None] + self.matrices[r]
            came.append(through.argmin(axis=0))
            cost = through.min(axis=0)
        out, state = [], end
        for r, back in zip(reversed(roles), reversed(came), strict=True):
            before = int(back[state])
            paid, action, way = self.options[r][before][state]
            out.append((state, action, way, float(paid)))
            state = before
        return out[::-1]


def _opened(state: int) -> str:
    return f"<|{ROLES[state - 1]}|>\n"


def repair(conversations: DataFrame, costs: Costs = Costs()) -> DataFrame:  # noqa: B008
    """(conv_id, turn, place, role, new_role, action, inserted, cost, rendered) per turn.

    place orders a conversation's turns; rendered, read in that order, is the repaired chat. inserted counts the empty
    turns before a turn (and after it, if it is the last), cost is what the turn's repair costs.
    """
    code = F.coalesce(F.array_position(F.array(*map(F.lit, ROLES)), F.lower(F.trim("role"))), F.lit(0))
    turns = conversations.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"), F.pmod(code - 1, F.lit(4)).cast("int").alias("code"))
    order = ["conv_id", F.col("turn").asc_nulls_last(), F.col("role").asc_nulls_first(), "text"]
    parts = int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    held = Stored(turns.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id())).df
    held = held.withColumn("part", F.shiftright("place", 33).cast("int"))
    roles = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "code"))), lambda x: x["code"].cast("string")), "")
    strings = Stored(held.groupBy("conv_id", "part").agg(roles.alias("roles"), F.min("place").alias("first"))).df
    kind = conversations.schema["conv_id"].dataType.simpleString()

    def measured(batches):
        machine = Automaton(costs)
        for batch in batches:
            flat = [machine.matrix(bytes(map(int, r))).ravel().tolist() for r in batch.column("roles").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("part"), pa.array(flat, pa.list_(pa.float64()))], ["conv_id", "part", "matrix"])

    matrices = strings.select("conv_id", "part", "roles").mapInArrow(measured, f"conv_id {kind}, part int, matrix array<double>")
    chains = matrices.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("part", "matrix"))).alias("chain"))

    def bordered(batches):
        machine = Automaton(costs)
        for batch in batches:
            ids, part, begin, end, last = [], [], [], [], []
            for i, chain in enumerate(batch.column("chain").to_pylist()):
                states = machine.borders([np.array(x["matrix"]).reshape(N_STATES, N_STATES) for x in chain])
                for k, x in enumerate(chain):
                    ids.append(i), part.append(x["part"]), begin.append(states[k]), end.append(states[k + 1]), last.append(k == len(chain) - 1)
            yield pa.RecordBatch.from_arrays([batch.column("conv_id").take(pa.array(ids, pa.int64())), pa.array(part, pa.int32()), pa.array(begin, pa.int32()), pa.array(end, pa.int32()), pa.array(last, pa.bool_())], ["_conv", "_part", "begin", "end", "last"])

    borders = chains.mapInArrow(bordered, f"_conv {kind}, _part int, begin int, end int, last boolean")
    bounded = strings.join(borders, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("part") == F.col("_part")))

    def decoded(batches):
        machine, known = Automaton(costs), {}
        for batch in batches:
            place, state, action, before, after, cost = [], [], [], [], [], []
            for row in batch.to_pylist():
                key = (row["roles"], row["begin"], row["end"])
                if key not in known:
                    if len(known) > 10_000 or len(row["roles"]) > 1_000:  # parts of few turns repeat
                        known = {}
                    known[key] = machine.decode(bytes(map(int, row["roles"])), row["begin"], row["end"])
                found = known[key]
                for k, (s, a, way, paid) in enumerate(found):
                    ends = machine.endings[s] if row["last"] and k == len(found) - 1 else ()
                    place.append(row["first"] + k), state.append(s), action.append(a), cost.append(paid + (machine.end_cost[s] if ends else 0.0))
                    before.append("".join(_opened(x) + "\n" for x in way) + (_opened(s) if a != 1 else ""))
                    after.append("\n" + "".join(_opened(x) + "\n" for x in ends))
            yield pa.RecordBatch.from_arrays(
                [pa.array(place, pa.int64()), pa.array(state, pa.int32()), pa.array(action, pa.int32()), pa.array(before, pa.string()), pa.array(after, pa.string()), pa.array(cost, pa.float64())], ["_place", "state", "_action", "_before", "_after", "cost"]
            )

    # a part is a byte a turn: by bytes very many would be put into one task
    choices = bounded.repartition(parts).select("roles", "first", "begin", "end", "last").mapInArrow(decoded, "_place long, state int, _action int, _before string, _after string, cost double")
    full = held.join(choices, F.col("place") == F.col("_place"))
    marks = F.regexp_count(F.concat("_before", "_after"), F.lit(r"<\|")) - F.when(F.col("_action") != 1, 1).otherwise(0)
    return full.select(
        "conv_id", "turn", "place", "role", F.element_at(F.array(*map(F.lit, ROLES)), F.col("state")).alias("new_role"), F.element_at(F.array(*map(F.lit, ACTIONS)), F.col("_action") + 1).alias("action"),
        marks.cast("int").alias("inserted"), "cost", F.concat("_before", F.regexp_replace("text", r"<(\\*)\|", r"<\\$1|"), "_after").alias("rendered"),
    )
