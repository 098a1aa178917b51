r"""Conversations put back into the order system? (user assistant)+ by the cheapest edits.

Every row has a symbol: the initial of its role and its first fault. The symbols of a conversation are its
signature, and equal signatures are repaired alike. The distinct signatures, read from the end, form an
automaton whose nodes are their distinct suffixes (signatures with a common end share its nodes). Spark
deals the signatures out sorted from the end, so that a task meets all signatures of a branch one after
the other; it computes the cost to go and the best first edit once for each node and grammar state, when
the node is entered, and reads the audit of every signature off the nodes.

Rows are streamed in the order of their conversation, never gathered: memory is a batch, the signature
and the audit of one conversation.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema, to_arrow_type
from pyspark.sql.types import StructType

from tallyhouse.llm.storage import stored

COLUMNS = ("conv_id", "turn", "role", "text")
BLANKS = " \t\n\x0b\f\r"

# Fixed values of the repair: costs, and the grammar's states by the last role written.
DELETE, INSERT, KEEP, REROLE = 4, 3, 0, 3
TRUNCATED = 3
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
AFTER_USER_OR_ASSISTANT = (USER, USER, ASSISTANT, USER)  # the only one of the two that may follow each state
KEPT = {"s": {NOTHING: SYSTEM}, "u": {NOTHING: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
ROLES = {USER: "user", ASSISTANT: "assistant"}
MUST_GO = "-"  # symbol of blank and repeated rows; others are the initial, in capitals if truncated
END_COSTS, END_EDITS = (0, 2 * INSERT, INSERT, 0), ".II."


def damaged(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with every twentieth row each dropped, emptied, without ends, repeated, made user.

    crc32 of ``conv_id:turn`` modulo 20 decides (0 to 4 in that order). A null in role or text is one space, as it is in
    the number; a null conv_id or turn stays one. Repeated rows are damaged alike.
    """
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    rows = turns.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"), kind.alias("kind"))
    rows = rows.where("kind != 0").select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "")
        .when(F.col("kind") == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text"))
        .alias("text"),
        F.when(F.col("kind") == 3, 2).otherwise(1).alias("times"),
    )
    return rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times")))).drop("times", "copy")


def _symbol(earlier: Column) -> Column:
    """-: blank, =: repeated, else the role's initial and . for a truncated or a space for a whole text."""
    initial = F.substring("role", 1, 1)
    # a text without a sign is blank; else its last one that is no blank decides
    last = F.substring(F.rtrim(F.col("text"), F.lit(BLANKS)), -1, 1)
    fault = F.when(last == "", "-").when(earlier, "=").when(last.isin(".", "!", "?"), " ").otherwise(".")
    return F.concat(fault, initial)


def _in_order(rows: DataFrame, *after_conversation: str) -> DataFrame:
    """rows dealt out by conversation and sorted by turn (nulls first), then role and text."""
    order = ["conv_id", *after_conversation, "turn", "role", "text"]
    return rows.repartition("conv_id").sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in order])


def _grouped(batches: Iterator[pa.RecordBatch], keys: str) -> Iterator[tuple]:
    """(values of a row, whether its key differs from the row before) for all rows of a partition."""
    before, first = None, True
    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
        at = batch.schema.get_field_index(keys)
        for row in zip(*columns, strict=True):
            yield row, first or row[at] != before
            before, first = row[at], False


def signatures(rows: DataFrame) -> DataFrame:
    """conv_id, signature, gaps, blank, duplicate, truncated, illegal, one row for every conversation of rows.

    Rows are taken by turn (null first), ties by role and text. A role without a letter has no initial that fits.
    """
    same = Window.partitionBy("conv_id", "role", "text").orderBy(F.col("turn").asc_nulls_first())
    marked = rows.repartition("conv_id").withColumn("nth", F.row_number().over(same))
    marked = marked.withColumn("symbol", _symbol(F.col("nth") > 1))
    order = [F.col(c).asc_nulls_first() for c in COLUMNS]
    ordered = marked.sortWithinPartitions(*order).select("conv_id", "turn", "symbol")

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def closed():
            gaps = last_turn - first_turn + 1 - distinct if distinct else 0
            values = (conversation, signature.decode(), gaps, blank, duplicate, truncated, illegal)
            return pa.RecordBatch.from_pylist([dict(zip(names, values, strict=True))], schema=arrow)

        some = False
        for (conv_id, turn, symbol), new in _grouped(batches, "conv_id"):
            if new:
                if some:
                    yield closed()
                some, conversation, signature = True, conv_id, bytearray()
                first_turn = last_turn = None
                distinct = blank = duplicate = truncated = illegal = 0
                before = None
            fault, initial = symbol[0], symbol[1:]
            blank += fault == "-"
            duplicate += fault == "="
            truncated += fault == "."
            illegal += before is not None and before + initial not in ("su", "ua", "au")
            before = initial
            if turn is not None and (distinct == 0 or turn != last_turn):
                first_turn = turn if distinct == 0 else first_turn
                last_turn, distinct = turn, distinct + 1
            letter = initial if initial in KEPT else "x"
            signature += (MUST_GO if fault in "-=" else letter.upper() if fault == "." else letter).encode()
        if some:
            yield closed()

    kind = rows.schema["conv_id"].dataType
    names = ["conv_id", "signature", "gaps", "blank", "duplicate", "truncated", "illegal"]
    arrow = pa.schema(
        [("conv_id", to_arrow_type(kind)), ("signature", pa.string()), *[(c, pa.int64()) for c in names[2:]]]
    )
    return ordered.mapInArrow(
        over, f"conv_id {kind.simpleString()}, signature string, " + ", ".join(f"{c} long" for c in names[2:])
    )


class Nodes:
    """The nodes on the way from the end of a signature to its start, with the answers of each.

    Node d is the suffix of d symbols. Its answers are, for each grammar state, the least cost to repair that
    suffix and the first edit (the least letter among the cheapest; edits of different letters lead to
    different nodes or states, so the least first letter begins the least audit).
    """

    def __init__(self):
        self.symbols, self.costs, self.edits = bytearray(), array("q", END_COSTS), bytearray(END_EDITS.encode())

    def cut(self, depth: int) -> None:
        del self.symbols[depth:], self.costs[4 * (depth + 1) :], self.edits[4 * (depth + 1) :]

    def enter(self, symbol: int) -> None:
        """The node one symbol further to the front."""
        rest = self.costs[-4:]
        sign = chr(symbol)
        costs, edits = [DELETE + c for c in rest], ["D"] * 4
        if sign != MUST_GO:
            extra = TRUNCATED if sign.isupper() else 0
            keep = KEPT.get(sign.lower(), {})
            for state in range(4):
                options = [(costs[state], "D"), (REROLE + extra + rest[AFTER_USER_OR_ASSISTANT[state]], "R")]
                if state in keep:
                    options.append((KEEP + extra + rest[keep[state]], "K"))
                costs[state], edits[state] = min(options)
        for _ in range(2):  # at most two rows are worth inserting in one place
            for state in range(4):
                option = (INSERT + costs[AFTER_USER_OR_ASSISTANT[state]], "I")
                if option < (costs[state], edits[state]):
                    costs[state], edits[state] = option
        self.symbols.append(symbol)
        self.costs.extend(costs)
        self.edits += "".join(edits).encode()

    def audit(self) -> tuple[int, str]:
        """Cost and edits of the whole signature, read off the nodes."""
        depth, state, out = len(self.symbols), NOTHING, bytearray()
        while True:
            edit = chr(self.edits[4 * depth + state])
            if edit == ".":
                return self.costs[4 * len(self.symbols) + NOTHING], out.decode()
            out += edit.encode()
            if edit in "IR":
                state = AFTER_USER_OR_ASSISTANT[state]
            elif edit == "K":
                state = KEPT[chr(self.symbols[depth - 1]).lower()][state]
            depth -= edit != "I"


BORDER = 64  # symbols from the end by which signatures are dealt out; equal ones are dealt on by hash


def audits(signed: DataFrame) -> DataFrame:
    """signature, cost, audit for every distinct signature.

    A node is computed once in each task that meets it. Branches are ranges of reversed signatures, so only
    the nodes on the way to a border are met by two tasks.
    """
    backwards = signed.select("signature").distinct().withColumn("backwards", F.reverse("signature"))
    dealt = backwards.repartitionByRange(F.substring("backwards", 1, BORDER), F.xxhash64("signature"))
    dealt = dealt.sortWithinPartitions("backwards")

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes = Nodes()
        for batch in batches:
            found = []
            for symbols in batch.column("backwards").to_pylist():
                symbols = symbols.encode()
                shared = _common(symbols, nodes.symbols)
                nodes.cut(shared)
                for symbol in symbols[shared:]:
                    nodes.enter(symbol)
                found.append(nodes.audit())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("signature"),
                    pa.array([c for c, _ in found], pa.int64()),
                    pa.array([a for _, a in found], pa.string()),
                ],
                names=["signature", "cost", "audit"],
            )

    return dealt.mapInArrow(over, "signature string, cost long, audit string")


def _common(x: bytes, y: bytes) -> int:
    """How many first bytes of x and y agree."""
    low, high = 0, min(len(x), len(y))
    while low < high:
        middle = (low + high + 1) // 2
        if x[low:middle] == y[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def _apply(edits: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """The repaired (role, text) pairs; takes one row of rows for every edit but an insertion."""
    state = NOTHING
    for edit in edits:
        role, text = ("", "") if edit == "I" else next(rows)
        if edit == "D":
            continue
        if edit == "K":
            state = KEPT[role[:1]][state]
        else:
            state = AFTER_USER_OR_ASSISTANT[state]
            role = ROLES[state]
        yield role, text


def repaired(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """conv_id, position, role, text: the rows after repair, by the audits in plans (conv_id, audit)."""
    return _streamed(rows, plans, "position long, role string, text string", _Rows)


def repaired_digest(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """conv_id, repaired_sha256: the hash of ``role:text`` of the repaired rows, joined by line ends."""
    return _streamed(rows, plans, "repaired_sha256 string", _Digest)


class _Rows:
    def __init__(self):
        self.position = 0

    def take(self, role, text):
        self.position += 1
        return [(self.position - 1, role, text)]

    def close(self):
        return []


class _Digest:
    def __init__(self):
        self.hash, self.some = hashlib.sha256(), False

    def take(self, role, text):
        self.hash.update(("\n" if self.some else "").encode() + role.encode() + b":" + text.encode())
        self.some = True
        return []

    def close(self):
        return [(self.hash.hexdigest(),)]


OUT_ROWS = 256


def _streamed(rows: DataFrame, plans: DataFrame, columns: str, collector: type) -> DataFrame:
    """Runs the audits over the rows in order. A conversation's audit comes before its rows, once."""
    kind = rows.schema["conv_id"].dataType
    heads = plans.select(
        "conv_id", F.lit(None).cast("long").alias("turn"), F.lit(None).cast("string").alias("role"), F.col("audit").alias("text"), F.lit(0).alias("part")
    )
    both = heads.unionByName(rows.select(*COLUMNS, F.lit(1).alias("part")))
    ordered = _in_order(both, "part").select("conv_id", "part", "role", "text")
    schema = StructType.fromDDL(f"conv_id {kind.simpleString()}, {columns}")
    arrow = to_arrow_schema(schema)

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for conversation, edits, own in _conversations(_grouped(batches, "conv_id")):
            collected = collector()
            for role, text in _apply(edits, own):
                out += [(conversation, *x) for x in collected.take(role, text)]
                if len(out) >= OUT_ROWS:
                    yield _batch(out, arrow)
                    out = []
            for _ in own:  # nothing is left but after an audit of another conversation
                raise ValueError("an audit does not fit its conversation")
            out += [(conversation, *x) for x in collected.close()]
        if out:
            yield _batch(out, arrow)

    return ordered.mapInArrow(over, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _conversations(rows: Iterator[tuple]) -> Iterator[tuple]:
    """(conv_id, audit, iterator over its (role, text)); each is to be read to the end before the next."""
    ahead = next(rows, None)
    while ahead is not None:
        (conversation, part, _, audit), _ = ahead
        if part != 0:
            raise ValueError("a conversation without an audit")

        def own():
            nonlocal ahead
            ahead = next(rows, None)
            while ahead is not None and not ahead[1]:
                yield ahead[0][2:]
                ahead = next(rows, None)

        yield conversation, audit, own()


def repair(turns: DataFrame) -> DataFrame:
    """One row for every conv_id of turns (null is one): gaps, faults, and the cheapest repair after damaged().

    conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256, signature. gaps counts the turns that are
    missing between the first and the last, nulls ignored. A conversation of which no row is left has zeros, an empty
    audit and the hash of nothing. Nulls are one space (a null turn comes first), ties are ordered by role and text,
    repeated rows are duplicates; other columns are ignored; an empty table gives no rows. A role whose first
    character is not s, u or a can only be changed or deleted.
    """
    turns = turns.select(*COLUMNS)
    rows = damaged(turns)
    signed = stored(signatures(rows))
    everything = turns.select("conv_id").distinct()
    plans = signed.join(stored(audits(signed)), "signature")
    plans = stored(
        everything.select(F.col("conv_id").alias("own_id"))
        .join(plans, F.col("own_id").eqNullSafe(F.col("conv_id")), "left")
        .select(
            F.col("own_id").alias("conv_id"),
            *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
            *[F.coalesce(c, F.lit("")).alias(c) for c in ("audit", "signature")],
        )
    )
    hashed = repaired_digest(rows, plans).withColumnRenamed("conv_id", "own_id")
    return plans.join(hashed, F.col("own_id").eqNullSafe(F.col("conv_id"))).select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256", "signature"
    )
