"""Conversation structure repair as a lightest derivation.

The rows of a conversation are kept, given another role or deleted, and empty
turns are inserted, so that the role initials read ``(s?(ua)+)?``; the cheapest
way wins, ties by the least audit string (one initial an edit, in order).

**Deductions.** An *item* (i, q) says: the rows from i on, read in state q of the
role pattern, can be repaired. The states are ``-`` (nothing yet), ``s``, ``u`` and
``a``; the axioms are (n, ``a``) and (n, ``-``). A hyperedge joins an *edit* (with a
cost and a letter, or, for a block of rows, with a whole audit) and the item
behind it to the item before it. Its value is the sum of the costs and the edit's
letters put in front of the audit.

**Agenda (Knuth).** Items wait with their (cost, rows covered, audit) and are
popped least first. Every hyperedge is monotone in both antecedents, and superior
in this order: an insertion raises the cost, any other edit covers one more row.
Between derivations of one item the rows covered are equal, so it is the order of
(cost, audit). (Cost and audit alone would not be superior: a kept row puts a
``K`` in front at no cost, which can be less than the audit it is put before.)
So a popped item is final, each is expanded once, and the search ends when the
goal (0, ``-``) is popped.

**On Spark.** Damage and faults are expressions. Rows are range-partitioned on
(conversation, turn, role, head of the text), sorted and written once with a
running number; blocks of ``BLOCK`` rows of that order are the unit of work, so a
conversation that holds any share of the rows is spread over many tasks. A
conversation in one block is one goal. For a longer one every block gets a value
for each pair of states (start, end), and a second agenda joins these items
(a hyperedge joins two spans); its audits are lists of shared pieces. What meets
at a conversation is its audit, at most sixteen letters a row, as it does in the
result. The hash runs over the sorted rows as they stream by, so no
conversation's text is held.

Defined results: null role, text and parts of the key are one space (the numbers
of turns stay null for ``gaps`` and sort first); rows of one turn are ordered by
role, then text; a null conversation id is a conversation; a conversation whose
rows are all dropped has zeros, an empty audit and the hash of the empty string;
repeated rows are duplicates; very long texts pass in the two shuffles; an empty
table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sifter.llm._common import read_table
from sifter.session import bounded_broadcast, materialise

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: Rows of one block: the values of a block are strings of about this length.
BLOCK = 1024
STATES = "-sua"
#: Role read in a state -> the next state.
STEP = {("-", "s"): "s", ("-", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
ACCEPTED = ("-", "a")
_BACK = {role: [(p, q) for (p, r), q in STEP.items() if r == role] for role in "sua"}


# -- the agenda ------------------------------------------------------------

def _row_edits(code: str) -> list[tuple[str, str, int, str]]:
    """(from, to, cost, letter) of the edits of one row. ``code`` is its role
    initial; upper case if it is truncated, ``!`` if it must go."""
    edits = [(q, q, DELETE, "D") for q in STATES]
    if code == "!":
        return edits
    extra = TRUNCATED if code.isupper() else 0
    own = code.lower()
    edits += [(p, q, KEEP + extra, "K") for p, q in _BACK.get(own, [])]
    edits += [(p, q, REROLE + extra, "R") for role in "ua" if role != own for p, q in _BACK[role]]
    return edits


#: Edits by the state behind them, for each code of a row.
_EDITS = {code: {q: [(p, cost, letter) for p, to, cost, letter in _row_edits(code) if to == q] for q in STATES} for code in "suaxSUAX!"}
_INSERTS = {q: [(p, INSERT, "I") for role in "ua" for p, to in _BACK[role] if to == q] for q in STATES}


def lightest(n: int, edits: Callable[[int, str], list], axioms: list[str], empty, goal: tuple[int, str] | None = None) -> dict:
    """Knuth's generalisation of Dijkstra's algorithm. ``edits(i, q)`` lists
    (state before, cost, audit) of the ways to cover unit i and end in q.
    Returns {(i, state): (cost, audit)} of the items finalised; stops at
    ``goal``."""
    agenda = [(0, 0, empty, q) for q in axioms]
    heapq.heapify(agenda)
    done: dict[tuple[int, str], tuple] = {}
    while agenda:
        cost, covered, audit, q = heapq.heappop(agenda)
        i = n - covered
        if (i, q) in done:
            continue
        done[i, q] = (cost, audit)
        if (i, q) == goal:
            break
        for p, c, letter in _INSERTS[q]:
            if (i, p) not in done:
                heapq.heappush(agenda, (cost + c, covered, letter + audit, p))
        if i:
            for p, c, letters in edits(i - 1, q):
                if (i - 1, p) not in done:
                    heapq.heappush(agenda, (cost + c, covered + 1, letters + audit, p))
    return done


def repair_rows(codes: str) -> tuple[int, str]:
    """(cost, audit) of one whole conversation."""
    goal = (0, "-")
    return lightest(len(codes), lambda i, q: _EDITS[codes[i]][q], list(ACCEPTED), "", goal)[goal]


def span_values(codes: str) -> list[tuple[str, str, int, str]]:
    """(start state, end state, cost, audit) of one block, for each pair that
    can be had."""
    out = []
    for end in STATES:
        done = lightest(len(codes), lambda i, q: _EDITS[codes[i]][q], [end], "")
        out += [(p, end, *done[0, p]) for p in STATES if (0, p) in done]
    return out


class Chain:
    """An audit in shared pieces; ordered as the joined string would be."""

    __slots__ = ("piece", "rest")

    def __init__(self, piece: str = "", rest: Chain | None = None):
        self.piece, self.rest = piece, rest

    def __radd__(self, piece: str) -> Chain:
        return Chain(piece, self)

    def pieces(self) -> Iterator[str]:
        at: Chain | None = self
        while at is not None:
            yield at.piece
            at = at.rest

    def __eq__(self, other) -> bool:
        return self is other or (not self < other and not other < self)

    def __lt__(self, other: Chain) -> bool:
        a, b, i, j = self, other, 0, 0
        while True:
            while a is not None and i == len(a.piece):
                a, i = a.rest, 0
            while b is not None and j == len(b.piece):
                b, j = b.rest, 0
            if a is b and i == j or b is None:
                return False
            if a is None:
                return True
            m = min(len(a.piece) - i, len(b.piece) - j)
            x, y = a.piece[i:i + m], b.piece[j:j + m]
            if x != y:
                return x < y
            i, j = i + m, j + m


def join_spans(blocks: list[list[tuple[str, str, int, str]]]) -> tuple[int, list[str]]:
    """(cost, audit of each block) of a conversation of several blocks. The
    values of the blocks already hold what is inserted between two blocks."""
    by_end = [{q: [(p, cost, audit) for p, to, cost, audit in spans if to == q] for q in STATES} for spans in blocks]
    agenda = [(0, 0, Chain(), q) for q in ACCEPTED]
    done = set()
    while True:
        cost, covered, audit, q = heapq.heappop(agenda)
        i = len(blocks) - covered
        if (i, q) in done:
            continue
        done.add((i, q))
        if (i, q) == (0, "-"):
            return cost, list(audit.pieces())[:-1]
        if i:
            for p, c, letters in by_end[i - 1][q]:
                if (i - 1, p) not in done:
                    heapq.heappush(agenda, (cost + c, covered + 1, letters + audit, p))


# -- rows ------------------------------------------------------------------

def damage(rows: DataFrame) -> DataFrame:
    """``rows (conv_id, turn, role, text)``, nulls as one space, damaged by
    the checksum of ``conv_id:turn``."""
    blank = F.lit(" ")
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), blank) for c in ("conv_id", "turn")])
    kind = F.crc32(key.cast("binary")) % 20
    role, text = (F.coalesce(F.col(c).cast("string"), blank) for c in ("role", "text"))
    return (rows.select("conv_id", "turn", kind.alias("kind"), role.alias("role"), text.alias("text")).where("kind <> 0")
            .select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
                    F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
                    F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))
            .drop("copy"))


def _is_blank(text: Column) -> Column:
    return F.length(F.translate(text, "\t\n\x0b\x0c\r ", "")) == 0


def _truncated(text: Column) -> Column:
    """The last character that is no blank is not one of ``.!?``."""
    return ~F.substring(F.rtrim(text, F.lit(" \t\n\x0b\x0c\r")), -1, 1).isin(".", "!", "?")


def number_rows(rows: DataFrame) -> DataFrame:
    """Rows in (conversation, turn, role, text) order with ``pos``, which rises
    with that order, ``fault`` and ``initial``; written once.

    A row is a duplicate if an earlier turn has its role and text, or the row
    before it in this order is the same. Earlier turns are looked up by
    digest in a table of the texts that stand in more than one turn."""
    same = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    at = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    again = (rows.select("conv_id", same.alias("same"), at.alias("at")).groupBy("conv_id", "same")
             .agg(F.min("at").alias("first"), F.max("at").alias("last")).where("first <> last")
             .select(F.col("conv_id").alias("conv_"), F.col("same").alias("same_"), "first"))
    again = bounded_broadcast(materialise(again, "repeated-turns"))
    keyed = rows.select("conv_id", "turn", "role", "text", same.alias("same"))
    marked = keyed.join(again, F.col("conv_id").eqNullSafe(F.col("conv_")) & (F.col("same") == F.col("same_")), "left")
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    dealt = (marked.withColumn("later", F.coalesce(at > F.col("first"), F.lit(False)))
             .repartitionByRange(order[0], order[1], F.substring("role", 1, 16), F.substring("text", 1, 64))
             .sortWithinPartitions(*order)
             .select("conv_id", "turn", "role", "text", "same", "later", F.monotonically_increasing_id().alias("pos")))
    rows = materialise(dealt, "turns")
    fault = F.when(_is_blank(F.col("text")), "blank").when(F.col("later"), "duplicate").when(_truncated(F.col("text")), "truncated").otherwise("")
    return rows.select("conv_id", "turn", "role", "text", "same", "pos", fault.alias("fault"), F.substring("role", 1, 1).alias("initial"))


def block_rows(rows: DataFrame, block: int) -> DataFrame:
    """One row for each (conversation, block of positions): its rows without
    their texts, and their faults. At most ``block`` rows meet in a group."""
    light = rows.select("conv_id", F.expr(f"pos div {block}").alias("block"), F.struct("pos", "turn", "same", "fault", "initial").alias("t"))
    got = light.groupBy("conv_id", "block").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    before = lambda i, c: F.get(F.col("ts"), i - 1)[c]
    # equal rows share turn, role and text, so they never leave their partition;
    # at the head of a block the row before is looked up below
    kinds = F.transform("ts", lambda t, i: F.when(
        t["fault"].isin("", "truncated") & (i > 0) & t["turn"].eqNullSafe(before(i, "turn")) & (t["same"] == before(i, "same")), "duplicate").otherwise(t["fault"]))
    return got.select("conv_id", "block", "ts", kinds.alias("kinds"))


_PAIRS = ("su", "ua", "au")


def conversation_blocks(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """``(conv_id, block, codes)`` (see ``_row_edits``) with the figures that
    add up over blocks; ``follows`` if a block of the conversation stands before.
    The last row of that block is looked up, so faults and neighbours over the
    border count."""
    b = block_rows(rows, block)
    ends = b.select("conv_id", "block", F.get("ts", F.size("ts") - 1).alias("tail"))
    w = Window.partitionBy("conv_id").orderBy("block")
    prev = ends.withColumn("prev", F.lag("tail").over(w)).where("prev is not null").select(
        F.col("conv_id").alias("conv_"), F.col("block").alias("block_"), "prev")
    several = bounded_broadcast(materialise(prev, "block-ends"))
    got = b.join(several, F.col("conv_id").eqNullSafe(F.col("conv_")) & (F.col("block") == F.col("block_")), "left")
    head = F.get("ts", F.lit(0))
    head_kind = F.when(F.get("kinds", F.lit(0)).isin("", "truncated") & F.coalesce(
        head["turn"].eqNullSafe(F.col("prev")["turn"]) & (head["same"] == F.col("prev")["same"]), F.lit(False)), "duplicate").otherwise(F.get("kinds", F.lit(0)))
    kinds = F.concat(F.array(head_kind), F.slice("kinds", F.lit(2), F.size("kinds")))
    got = got.withColumn("kinds", kinds)
    code = lambda t, k: F.when(k.isin("blank", "duplicate"), "!").otherwise(F.when(
        t["initial"].isin("s", "u", "a"), F.when(k == "truncated", F.upper(t["initial"])).otherwise(t["initial"]))
        .otherwise(F.when(k == "truncated", "X").otherwise("x")))
    codes = F.array_join(F.zip_with("ts", "kinds", code), "")
    count = lambda kind: F.size(F.filter("kinds", lambda k: k == kind)).cast("bigint").alias(kind)
    initials = F.concat(F.when(F.col("prev").isNotNull(), F.array(F.col("prev")["initial"])).otherwise(F.array().cast("array<string>")),
                        F.transform("ts", lambda t: t["initial"]))
    illegal = F.size(F.filter(F.transform(F.sequence(F.lit(1), F.size("chars")), lambda i: (i < F.size("chars")) & ~F.concat(
        F.get("chars", i - 1), F.coalesce(F.get("chars", i), F.lit(""))).isin(*_PAIRS)), lambda x: x))
    return (got.withColumn("chars", initials)
            .select("conv_id", "block", codes.alias("codes"), count("blank"), count("duplicate"), count("truncated"),
                    illegal.cast("bigint").alias("illegal"), F.col("prev").isNotNull().alias("follows")))


# -- repair ----------------------------------------------------------------

_SPANS = "array<struct<p:string,q:string,cost:bigint,audit:string>>"


def solve_blocks(blocks: DataFrame) -> DataFrame:
    """Adds ``spans``: the one value of a conversation in one block (start and
    end ``-``), else the values of the block for every pair of states."""
    several = bounded_broadcast(blocks.where("follows").select(F.col("conv_id").alias("conv_")).distinct().withColumn("many", F.lit(True)))
    rows = (blocks.join(several, F.col("conv_id").eqNullSafe(F.col("conv_")), "left")
            .select("conv_id", "block", F.coalesce("many", F.lit(False)).alias("many"), "codes"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[str, tuple[int, str]] = {}
        span = pa.list_(pa.struct([("p", pa.string()), ("q", pa.string()), ("cost", pa.int64()), ("audit", pa.string())]))
        for b in batches:
            out = []
            for many, codes in zip(b.column("many").to_pylist(), b.column("codes").to_pylist()):
                if many:
                    values = span_values(codes)
                else:
                    if len(memo) > 50_000:
                        memo.clear()
                    got = memo.get(codes) or memo.setdefault(codes, repair_rows(codes))
                    values = [("-", "-", *got)]
                out.append([dict(zip(("p", "q", "cost", "audit"), v)) for v in values])
            yield pa.RecordBatch.from_arrays([b.column("conv_id"), b.column("block"), pa.array(out, span)], names=["conv_id", "block", "spans"])

    kind = rows.schema["conv_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"conv_id {kind}, block bigint, spans {_SPANS}")


def join_blocks(solved: DataFrame) -> DataFrame:
    """``(conv_id, cost, audits array<struct<block, audit>>)``."""
    got = solved.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("block", "spans"))).alias("bs"))
    one = F.get("bs", F.lit(0))
    first = F.get(one["spans"], F.lit(0))
    single = got.where(F.size("bs") == 1).select("conv_id", first["cost"].alias("cost"),
                                                F.array(F.struct(one["block"].alias("block"), first["audit"].alias("audit"))).alias("audits"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("block", pa.int64()), ("audit", pa.string())]))
        for b in batches:
            for i in range(b.num_rows):
                blocks = b.column("bs")[i].as_py()
                cost, audits = join_spans([[(s["p"], s["q"], s["cost"], s["audit"]) for s in x["spans"]] for x in blocks])
                pieces = [{"block": x["block"], "audit": a} for x, a in zip(blocks, audits)]
                yield pa.RecordBatch.from_arrays([b.column("conv_id").slice(i, 1), pa.array([cost]), pa.array([pieces], kind)],
                                                 names=["conv_id", "cost", "audits"])

    kind = got.schema["conv_id"].dataType.simpleString()
    several = got.where(F.size("bs") > 1).mapInArrow(run, f"conv_id {kind}, cost bigint, audits array<struct<block:bigint,audit:string>>")
    return single.unionByName(several)


def apply_edits(rows: DataFrame, repaired: DataFrame, block: int = BLOCK) -> DataFrame:
    """The repaired rows: ``conv_id, pos, k, role, text`` in the order (pos, k).

    The audit of a block stands before the block's rows in one sorted stream a
    conversation, so a row's edit is read off as it goes by."""
    letters = repaired.select("conv_id", F.explode("audits").alias("x")).select(
        "conv_id", (F.col("x")["block"] * block).alias("pos"), F.lit(True).alias("head"), F.lit("").alias("role"), F.col("x")["audit"].alias("text"))
    turns = rows.select("conv_id", "pos", F.lit(False).alias("head"), "role", "text")
    both = (letters.unionByName(turns).repartition("conv_id")
            .sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "pos", F.col("head").desc()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, audit, at, state = object(), "", 0, "-"
        for b in batches:
            out: list[tuple] = []

            def put(i: int, pos: int, role: str, text: str, k: int = 0) -> None:
                nonlocal state
                state = "a" if state == "u" else "s" if role.startswith("s") and state == "-" else "u"
                out.append((i, pos, k, role, text))

            conv, poses, heads, roles, texts = (b.column(c).to_pylist() for c in ("conv_id", "pos", "head", "role", "text"))
            for i, (c, pos, head, role, text) in enumerate(zip(conv, poses, heads, roles, texts)):
                if c != now:
                    now, state = c, "-"
                if head:
                    audit, at = text, 0
                    continue
                k = 0
                while audit[at] == "I":
                    put(i, pos, "assistant" if state == "u" else "user", "", k)
                    at, k = at + 1, k + 1
                edit = audit[at]
                at += 1
                if edit != "D":
                    put(i, pos, role if edit == "K" else "assistant" if state == "u" else "user", text, k)
                    k += 1
                # insertions behind the last row of a block
                while at < len(audit) and not audit[at:].strip("I"):
                    put(i, pos, "assistant" if state == "u" else "user", "", k)
                    at, k = at + 1, k + 1
            cols = list(zip(*out)) if out else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [b.column("conv_id").take(pa.array(cols[0], pa.int64())), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int32()),
                 pa.array(cols[3], pa.string()), pa.array(cols[4], pa.string())], names=["conv_id", "pos", "k", "role", "text"])

    kind = rows.schema["conv_id"].dataType.simpleString()
    return both.mapInArrow(run, f"conv_id {kind}, pos bigint, k int, role string, text string")


def digest(repaired_rows: DataFrame) -> DataFrame:
    """``(conv_id, repaired_sha256)`` of the streamed rows of ``apply_edits``
    (a conversation's rows stand together, in order)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sha, started, like = None, None, False, None

        def flush():
            return pa.RecordBatch.from_arrays([like, pa.array([sha.hexdigest()])], names=["conv_id", "repaired_sha256"])

        for b in batches:
            like_column = b.column("conv_id")
            for i, (c, role, text) in enumerate(zip(like_column.to_pylist(), b.column("role").to_pylist(), b.column("text").to_pylist())):
                if not started or c != now:
                    if started:
                        yield flush()
                    now, sha, started, like = c, hashlib.sha256(), True, like_column.slice(i, 1)
                else:
                    sha.update(b"\n")
                sha.update(f"{role}:{text}".encode())
        if started:
            yield flush()

    kind = repaired_rows.schema["conv_id"].dataType.simpleString()
    return repaired_rows.mapInArrow(run, f"conv_id {kind}, repaired_sha256 string")


def repair(turns: DataFrame, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """For rows (conv_id, turn, role, text) without null role or text: the
    report, a row for each conversation, and the repaired rows (a stream of
    ``apply_edits``)."""
    rows = number_rows(turns)
    blocks = materialise(conversation_blocks(rows, block), "blocks")
    repaired = materialise(join_blocks(solve_blocks(blocks)), "repaired")
    figures = blocks.groupBy("conv_id").agg(*[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")])
    numbers = (rows.where("turn is not null").select("conv_id", "turn").distinct().groupBy("conv_id")
               .agg((F.max("turn") - F.min("turn") + 1 - F.count("turn")).cast("bigint").alias("gaps")))
    audit = F.array_join(F.transform("audits", lambda x: x["audit"]), "")
    key = F.col("conv_id").eqNullSafe(F.col("conv_"))

    def side(df: DataFrame) -> DataFrame:
        return df.withColumnRenamed("conv_id", "conv_")

    report = repaired.select("conv_id", "cost", audit.alias("audit"))
    for part in (figures, numbers):
        report = report.join(side(part), key, "left").drop("conv_")
    return report, apply_edits(rows, repaired, block)


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract: conv_id, gaps, blank, duplicate, truncated, illegal, cost,
    audit, repaired_sha256 of every conversation of the table."""
    table = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    report, repaired = repair(damage(table))
    key = F.col("conv_id").eqNullSafe(F.col("conv_"))
    longs = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    got = (table.select("conv_id").distinct()
           .join(report.withColumnRenamed("conv_id", "conv_"), key, "left").drop("conv_")
           .join(digest(repaired).withColumnRenamed("conv_id", "conv_"), key, "left"))
    return got.select("conv_id", *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in longs],
                      F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def _value(x: str, cost: int, letter: str) -> str:
    """Cost in ten digits and audit as one string, so that least() orders values."""
    return f"lpad(CAST(CAST({x}[1:10] AS BIGINT) + {cost} AS VARCHAR), 10, '0') || '{letter}' || {x}[11:]"


def _oracle() -> str:
    ins = lambda x: _value(x, INSERT, "I")
    close = f"""least(e, {ins('u1')}) AS e, least(s, {ins('u1')}) AS s, u1 AS u, a1 AS a
    FROM (SELECT *, least(u, {ins('a')}) AS u1, least(a, {ins('u')}) AS a1"""

    def step(state: str, keeps: dict[str, str]) -> str:
        after = keeps.get("u") or keeps.get("a")
        ways = [_value(f"r.{state}", DELETE, "D")]
        for own, to in keeps.items():
            ways.append(f"CASE WHEN fault IN ('', 'truncated') AND own = '{own}' THEN CASE WHEN fault = '' THEN {_value('r.' + to, KEEP, 'K')} "
                        f"ELSE {_value('r.' + to, KEEP + TRUNCATED, 'K')} END END")
        ways.append(f"CASE WHEN fault = '' THEN {_value('r.' + after, REROLE, 'R')} WHEN fault = 'truncated' THEN "
                    f"{_value('r.' + after, REROLE + TRUNCATED, 'R')} END")
        return f"least({', '.join(ways)})"

    return rf"""
WITH RECURSIVE d AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(
           string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda c: ascii(c)::BIGINT)),
           lambda crc, b: xor(crc >> 8, list_reduce(list_concat([xor(crc, b) & 255], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
             lambda c, z: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384::BIGINT ELSE 0 END)))), 4294967295::BIGINT) % 20 AS kind
  FROM conversations),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM d WHERE kind <> 0),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged),
t AS MATERIALIZED (
  SELECT *, count(*) OVER (PARTITION BY conv_id) AS n, left(role, 1) AS own,
         CASE WHEN NOT regexp_matches(text, '[^ 	-
]') THEN 'blank'
              WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
              WHEN NOT regexp_matches(text, '[.!?][ 	-
]*\z') THEN 'truncated' ELSE '' END AS fault
  FROM numbered),
rec AS (
  SELECT conv_id, i, {close}
    FROM (SELECT DISTINCT conv_id, n + 1 AS i, '0000000000' AS e, NULL::VARCHAR AS s, NULL::VARCHAR AS u, '0000000000' AS a FROM t))
  UNION ALL
  SELECT conv_id, i, {close}
    FROM (SELECT t.conv_id, t.i, {step('e', {'s': 's', 'u': 'u'})} AS e, {step('s', {'u': 'u'})} AS s,
                 {step('u', {'a': 'a'})} AS u, {step('a', {'u': 'u'})} AS a
          FROM rec AS r JOIN t ON t.conv_id IS NOT DISTINCT FROM r.conv_id AND t.i = r.i - 1))),
best AS MATERIALIZED (SELECT conv_id, CAST(e[1:10] AS BIGINT) AS cost, e[11:] AS audit FROM rec WHERE i = 1),
letters AS (
  SELECT conv_id, p, letter, count(*) FILTER (WHERE letter <> 'I') OVER w AS i, count(*) FILTER (WHERE letter <> 'D') OVER w AS o
  FROM (SELECT conv_id, unnest(string_split(audit, '')) AS letter, generate_subscripts(string_split(audit, ''), 1) AS p FROM best WHERE audit <> '')
  WINDOW w AS (PARTITION BY conv_id ORDER BY p)),
edited AS (
  SELECT l.conv_id, p, o, letter, t.role, t.text, max(CASE WHEN o = 1 AND letter = 'K' AND own = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY l.conv_id) AS sys
  FROM letters AS l LEFT JOIN t ON t.conv_id IS NOT DISTINCT FROM l.conv_id AND t.i = l.i AND letter <> 'I' WHERE letter <> 'D'),
repaired AS (
  SELECT conv_id, string_agg(CASE WHEN letter = 'K' THEN role WHEN (o - sys) % 2 = 1 THEN 'user' ELSE 'assistant' END
                             || ':' || coalesce(text, ''), chr(10) ORDER BY p) AS said FROM edited GROUP BY conv_id),
pairs AS (SELECT conv_id, turn, fault, own, lag(own) OVER (PARTITION BY conv_id ORDER BY i) AS prev FROM t),
figures AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'blank') AS blank,
         count(*) FILTER (WHERE fault = 'duplicate') AS duplicate, count(*) FILTER (WHERE fault = 'truncated') AS truncated,
         count(*) FILTER (WHERE prev IS NOT NULL AND prev || own NOT IN ('su', 'ua', 'au')) AS illegal FROM pairs GROUP BY conv_id)
SELECT c.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit,
       sha256(coalesce(said, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS c
LEFT JOIN figures AS f ON f.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN best AS b ON b.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN repaired AS r ON r.conv_id IS NOT DISTINCT FROM c.conv_id
"""


ORACLE = _oracle()
