"""Conversation structure repair by iterative-deepening A*.

A conversation is legal if its roles read ``(system? (user assistant)+)?``.  Edits in the order
of their initials: Delete a row (4), Insert an empty-text user or assistant (3), Keep (0),
Rerole to user or assistant (3); blank rows and rows that repeat an earlier role and text must
go, and a truncated row that stays costs 3 more.  At every state only one role can be inserted
or given, so the initials alone say what happens.

The search goes depth first in ASCII order of the initials under a cost bound; a state (rows
read, place in the role pattern) that failed is entered in a table with the least budget that
may still succeed there, and the bound rises to the least budget the start needs.  The first
accepting path is the cheapest one and, of several, the least in ASCII order.  The table lasts
over the bounds of a search.  Long conversations are searched in stretches of ``STRETCH_ROWS``
from the back: the costs to finish from the end of a stretch, in each place of the pattern, are
the end costs of the stretch before, so the work is linear in the rows, and no first path is
lost since a stretch ends with the edit that reads its last row.

On Spark: rows become one-byte codes (fault and role initial); range partitions, which also
cut a large conversation, give strings of codes, and only these meet in one place: a byte per
row, as many as the audit has.  The audit then goes through the rows once more, sorted by
conversation, as a first row of each conversation, so that texts are streamed, not gathered.
The texts of one conversation pass through one task, because their joined hash is one sequence;
a task holds one row of them at a time.

Results by case: null role and text count as one blank, so a null text is blank, and a null or
unknown role is illegal and can only be rerolled or deleted; an empty role too.  Null ids are
one conversation; null turns come first and count for no gap.  Rows of one turn are ordered by
role, then by the SHA-256 of their text.  Texts of any length are read whole.  Rows that are
equal are repetitions.  A conversation without rows after damage has no faults, an empty audit
and no rows.  An empty table gives an empty table.  Other input columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logweave.llm.common import col, ship_code

WHITE = " \t\n\x0b\x0c\r"
#: places in the role pattern
START, AFTER_SYSTEM, AFTER_USER, AFTER_ASSISTANT = range(4)
ROLES = ("system", "user", "assistant")
#: fixed values: the costs of the edits
DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
#: faults as they are coded
NONE, BLANK, DUPLICATE, CUT = range(4)
#: rows that are searched at once
STRETCH_ROWS = 32
#: rows whose codes are one string before strings are put together
CODES_ROWS = 8192
_MANY = 1 << 60

#: role initial -> (place -> next place) for a row that keeps its role
_KEPT = {"s": {START: AFTER_SYSTEM}, "u": {START: AFTER_USER, AFTER_SYSTEM: AFTER_USER, AFTER_ASSISTANT: AFTER_USER},
         "a": {AFTER_USER: AFTER_ASSISTANT}}
_INITIALS = "sua"
#: place -> the place after the one role that may be inserted or given there
_GIVEN = {START: AFTER_USER, AFTER_SYSTEM: AFTER_USER, AFTER_USER: AFTER_ASSISTANT, AFTER_ASSISTANT: AFTER_USER}


# -- the search -----------------------------------------------------------------

def code_of(fault: int, initial: str) -> str:
    """One hexadecimal digit for a row's fault and role initial."""
    known = _INITIALS.find(initial) if initial else -1
    return "%x" % (4 * fault + (known if known >= 0 else 3))


def _steps(codes: str) -> list[tuple]:
    """For each row: its cost if it stays (None: it must go) and where it leads if it keeps its role."""
    rows = []
    for code in codes:
        fault, initial = divmod(int(code, 16), 4)
        stays = None if fault in (BLANK, DUPLICATE) else TRUNCATED if fault == CUT else 0
        rows.append((stays, _KEPT[_INITIALS[initial]] if initial < 3 else {}))
    return rows


class _Search:
    """The cheapest, then least, edits from the first row of a stretch to its end."""

    def __init__(self, rows: list[tuple], end_costs: list[int] | None):
        self._rows = rows
        # what every end costs is added at the end; None: the end of the conversation
        self._base = min(end_costs) if end_costs is not None else 0
        self._end_costs = [c - self._base for c in end_costs] if end_costs is not None else None
        # what the remaining rows cost whatever the roles
        self._least = [0] * (len(rows) + 1)
        for k in range(len(rows) - 1, -1, -1):
            stays = rows[k][0]
            self._least[k] = self._least[k + 1] + (DELETE if stays is None else min(DELETE, stays))
        self._failed: dict[tuple[int, int], int] = {}          # state -> least budget not yet ruled out

    def _edits(self, at: int, place: int):
        """(initial, cost, next row, next place) in ASCII order."""
        if at < len(self._rows):
            stays, kept = self._rows[at]
            yield "D", DELETE, at + 1, place
            yield "I", INSERT, at, _GIVEN[place]
            if stays is not None:
                if place in kept:
                    yield "K", stays, at + 1, kept[place]
                yield "R", REROLE + stays, at + 1, _GIVEN[place]
        else:
            yield "I", INSERT, at, _GIVEN[place]

    def _needs(self, at: int, place: int) -> int:
        """A budget below which the state surely fails."""
        return self._failed.get((at, place), self._least[at])

    def _accepts(self, at: int, place: int) -> int | None:
        """The cost to finish where a path may end, else None."""
        if at < len(self._rows):
            return None
        if self._end_costs is not None:
            return self._end_costs[place]
        return 0 if place in (START, AFTER_ASSISTANT) else None

    def run(self, place: int) -> tuple[int, str, int]:
        """(cost with the end cost, initials, last place) from the first row in ``place``."""
        while True:
            bound = self._needs(0, place)
            path = self._within(place, bound)
            if path is not None:
                return self._base + bound, path[0], path[1]

    def _within(self, place: int, bound: int) -> tuple[str, int] | None:
        """The first path of at most ``bound``; an explicit stack, as stretches may be long."""
        stack = [[0, place, bound, self._edits(0, place), _MANY]]
        path: list[str] = []
        while stack:
            frame = stack[-1]
            at, here, budget, edits, _ = frame
            finish = self._accepts(at, here) if budget >= self._needs(at, here) else None
            if finish is not None and finish <= budget:
                return "".join(path), here
            if finish is not None and self._end_costs is not None:
                frame[4] = finish
                edits = frame[3] = iter(())
            deeper = None
            for initial, cost, next_at, next_place in edits:
                least = cost + self._needs(next_at, next_place)
                if least <= budget:
                    deeper = [next_at, next_place, budget - cost, self._edits(next_at, next_place), _MANY]
                    frame.append(cost)
                    path.append(initial)
                    break
                frame[4] = min(frame[4], least)
            if deeper is not None:
                stack.append(deeper)
                continue
            # every edit failed: the state needs more than it had
            stack.pop()
            self._failed[at, here] = max(frame[4], budget + 1)
            if stack:
                path.pop()
                above = stack[-1]
                above[4] = min(above[4], above.pop() + self._failed[at, here])
        return None


def cheapest_edits(codes: str, stretch: int = STRETCH_ROWS) -> tuple[int, str]:
    """Cost and initials of the cheapest edits of a conversation given as codes."""
    rows = _steps(codes)
    starts = list(range(0, len(rows), stretch)) or [0]
    end_costs, found = None, []
    for start in reversed(starts):
        part = rows[start:start + stretch]
        search = _Search(part, end_costs)
        places = (START,) if start == 0 else range(4)
        answers = {place: search.run(place) for place in places}
        found.append(answers)
        end_costs = [answers[p][0] if p in answers else _MANY for p in range(4)]
    place, audit = START, []
    for answers in reversed(found):
        _, initials, place = answers[place]
        audit.append(initials)
    return end_costs[START], "".join(audit)


def apply_edits(edits: Iterator[str], rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of every row that the edits leave."""
    place = START
    for edit in edits:
        if edit == "I":
            role, text, place = ROLES[_GIVEN[place] - 1], "", _GIVEN[place]
        else:
            role, text = next(rows)
            if edit == "D":
                continue
            if edit == "R":
                place = _GIVEN[place]
                role = ROLES[place - 1]
            else:
                place = _KEPT[role[:1]][place]
        yield edit, role, text


# -- on Spark -------------------------------------------------------------------

def damage(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text") -> DataFrame:
    """``conv``, ``turn``, ``role``, ``text`` and ``copies``: rows with the faults that the CRC-32 of
    ``conv:turn`` gives them (modulo 20: 0 drops, 1 empties, 2 takes end marks, 3 repeats, 4 makes user)."""
    def words(name: str) -> Column:
        return F.coalesce(col(name).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(words(conv), F.lit(":"), words(turn)).cast("binary")) % 20
    marked = rows.select(col(conv).alias("conv"), col(turn).alias("turn"), words(role).alias("role"),
                         words(text).alias("text"), fault.alias("fault"))
    return marked.filter("fault <> 0").select(
        "conv", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text")).alias("text"),
        F.when(F.col("fault") == 3, 2).otherwise(1).cast("long").alias("copies"))


def _row_codes(rows: DataFrame) -> DataFrame:
    """Distinct rows (by the hash of their text) with their number, fault and whether they are the first."""
    bare = F.rtrim(F.col("text"), F.lit(WHITE))
    fault = F.when(bare == "", BLANK).when(F.right(bare, F.lit(1)).isin(".", "!", "?"), NONE).otherwise(CUT)
    narrow = rows.select("conv", "turn", "role", F.sha2("text", 256).alias("sha"), fault.alias("fault"), "copies")
    same = narrow.groupBy("conv", "turn", "role", "sha").agg(
        F.sum("copies").alias("copies"), F.max("fault").alias("fault"))
    # the first turn of every role and text, nulls before all others
    firsts = same.groupBy("conv", "role", "sha").agg(
        F.min(F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))).alias("least"))
    marked = same.select("conv", "turn", "role", "sha", "copies", "fault", F.lit(False).alias("first")).unionByName(
        firsts.select("conv", F.col("least.turn").alias("turn"), "role", "sha", F.lit(0).cast("long").alias("copies"),
                      F.lit(NONE).alias("fault"), F.lit(True).alias("first")))
    return marked.groupBy("conv", "turn", "role", "sha").agg(
        F.sum("copies").alias("copies"), F.max("fault").alias("fault"), F.max("first").alias("first"))


def _strings(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Runs of a conversation's rows, in order, as strings of codes with the key of their first row."""
    key, head, codes = None, None, []
    done: list[tuple] = []

    def close():
        if codes:
            done.append((key[0], *head, "".join(codes)))
            codes.clear()

    for batch in batches:
        for conv, turn, role, sha, copies, fault, first in zip(*[c.to_pylist() for c in batch.columns]):
            if key != (conv,) or len(codes) >= CODES_ROWS:
                close()
                key, head = (conv,), (turn is not None, turn, role, sha)
            initial = role[:1]
            single = code_of(fault, initial) if first or fault == BLANK else code_of(DUPLICATE, initial)
            codes.append(single)
            if copies > 1:
                again = code_of(BLANK if fault == BLANK else DUPLICATE, initial)
                codes.append(again * (copies - 1))
        if len(done) >= 1000:
            yield _batch(done, schema)
            done = []
    close()
    if done:
        yield _batch(done, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def judge_codes(codes: str) -> tuple[int, int, int, int, int, str]:
    """(blank, duplicate, truncated, illegal, cost, audit) of a conversation given as codes."""
    counts = {f: sum(codes.count("%x" % (4 * f + k)) for k in range(4)) for f in (BLANK, DUPLICATE, CUT)}
    initials = codes.translate({ord("%x" % k): (_INITIALS + "?")[k % 4] for k in range(16)})
    legal = sum(_count_pairs(initials, pair) for pair in ("su", "ua", "au"))
    cost, audit = cheapest_edits(codes)
    return (counts[BLANK], counts[DUPLICATE], counts[CUT], max(len(codes) - 1, 0) - legal, cost, audit)


def _count_pairs(text: str, pair: str) -> int:
    return text.count(pair)          # the two letters differ, so occurrences do not overlap


def find_repairs(rows: DataFrame) -> DataFrame:
    """Per conversation of damaged rows: ``conv``, its faults, ``gaps``, ``cost`` and ``audit``."""
    from pyspark.sql.pandas.types import to_arrow_schema
    ship_code(rows.sparkSession)
    conv_type, turn_type = rows.schema["conv"].dataType, rows.schema["turn"].dataType
    coded = _row_codes(rows)
    string_schema = T.StructType([
        T.StructField("conv", conv_type), T.StructField("known", T.BooleanType()), T.StructField("turn", turn_type),
        T.StructField("role", T.StringType()), T.StructField("sha", T.StringType()),
        T.StructField("codes", T.StringType())])
    arrow = to_arrow_schema(string_schema)
    order = ["conv", F.col("turn").asc_nulls_first(), "role", "sha"]
    strings = (coded.repartitionByRange(*order).sortWithinPartitions(*order)
               .select("conv", "turn", "role", "sha", "copies", "fault", "first")
               .mapInArrow(lambda batches: _strings(batches, arrow), string_schema))
    whole = strings.groupBy("conv").agg(F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct("known", "turn", "role", "sha", "codes"))), lambda s: s["codes"]),
        "").alias("codes"))
    judged_schema = T.StructType([T.StructField("conv", conv_type), *[
        T.StructField(n, T.LongType()) for n in ("blank", "duplicate", "truncated", "illegal", "cost")],
        T.StructField("audit", T.StringType())])
    judged_arrow = to_arrow_schema(judged_schema)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(c, *judge_codes(codes)) for c, codes in zip(*[x.to_pylist() for x in batch.columns])]
            if rows:
                yield _batch(rows, judged_arrow)

    judged = whole.mapInArrow(judge, judged_schema)
    turns = (rows.groupBy("conv", "turn").agg(F.lit(1).alias("one")).groupBy("conv").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long").alias("gaps")))
    return judged.join(turns.withColumnRenamed("conv", "of"), F.col("conv").eqNullSafe(F.col("of")), "left").drop("of")


def repaired_rows(rows: DataFrame, repairs: DataFrame) -> DataFrame:
    """The rows that the audits leave: ``conv``, ``position`` (from 0), ``edit``, ``role``, ``text``.

    All rows of a conversation are in one partition, in order; a conversation that keeps no row
    is not among them.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    ship_code(rows.sparkSession)
    conv_type = rows.schema["conv"].dataType
    turn_type = rows.schema["turn"].dataType
    null = lambda kind: F.lit(None).cast(kind)
    texts = rows.select("conv", F.lit(1).alias("kind"), "turn", "role", F.sha2("text", 256).alias("sha"),
                        "text", "copies", null("string").alias("audit"))
    audits = repairs.select("conv", F.lit(0).alias("kind"), null(turn_type).alias("turn"), null("string").alias("role"),
                            null("string").alias("sha"), null("string").alias("text"),
                            F.lit(0).cast("long").alias("copies"), "audit")
    stream = texts.unionByName(audits).repartition("conv").sortWithinPartitions(
        "conv", "kind", F.col("turn").asc_nulls_first(), "role", "sha").select(
        "conv", "role", "text", "copies", "audit")
    schema = T.StructType([T.StructField("conv", conv_type), T.StructField("position", T.LongType()),
                           *[T.StructField(n, T.StringType()) for n in ("edit", "role", "text")]])
    arrow = to_arrow_schema(schema)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        size = 0
        for conv, audit, said in _conversations(batches):
            for position, (edit, role, text) in enumerate(apply_edits(iter(audit), said)):
                out.append((conv, position, edit, role, text))
                size += len(text)
                if len(out) >= 4096 or size >= 1 << 22:
                    yield _batch(out, arrow)
                    out, size = [], 0
        if out:
            yield _batch(out, arrow)

    return stream.mapInArrow(work, schema)


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv, audit, its rows) in turn; the rows must be read before the next conversation."""
    stream = ((conv, role, text, copies, audit) for batch in batches
              for conv, role, text, copies, audit in zip(*[c.to_pylist() for c in batch.columns]))
    waiting = next(stream, None)
    while waiting is not None:
        conv, _, _, _, audit = waiting           # the audit comes first
        waiting = None

        def said():
            nonlocal waiting
            for row in stream:
                if row[4] is not None:
                    waiting = row
                    return
                yield from [row[1:3]] * row[3]

        rows = said()
        yield conv, audit, rows
        for _ in rows:
            pass


def conversation_hashes(repaired: DataFrame, line: Callable[[str, str], str] = "{}:{}".format) -> DataFrame:
    """``conv`` and ``repaired_sha256`` of the joined lines of each conversation, read in one pass."""
    from pyspark.sql.pandas.types import to_arrow_schema
    schema = T.StructType([repaired.schema["conv"], T.StructField("repaired_sha256", T.StringType())])
    arrow = to_arrow_schema(schema)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, digest, current = [], None, None
        for batch in batches:
            for conv, position, role, text in zip(*[c.to_pylist() for c in batch.columns]):
                if position == 0:
                    if digest is not None:
                        out.append((current, digest.hexdigest()))
                    digest, current = hashlib.sha256(), conv
                else:
                    digest.update(b"\n")
                digest.update(line(role, text).encode("utf-8"))
            if len(out) >= 1000:
                yield _batch(out, arrow)
                out = []
        if digest is not None:
            out.append((current, digest.hexdigest()))
        if out:
            yield _batch(out, arrow)

    return repaired.select("conv", "position", "role", "text").mapInArrow(work, schema)
