"""Conversation structure repair: cheapest edits by a rank-convergent parallel
Viterbi pass.

A repaired conversation's role initials are ``(s?(ua)+)?``; what was written
so far is one of four states, and each row is kept, given another role or
deleted, with empty rows put in anywhere.  The cost of the cheapest way on
from each state is a vector of four; a row maps the vector behind it to the
one before it.  Vectors of long conversations converge: after few rows they
differ only by a constant, whatever stood at the end.

So a conversation is cut into chunks.  Every chunk starts from a speculative
vector; then fix-up passes hand each chunk the vector of its successor and
rerun it from its end, up to the row where old and new vectors differ only by
a constant.  The passes end when no chunk's successor changes.  A forward walk
over the stitched costs takes, at each step, the least letter that stays
cheapest: each chunk is walked from all four states, the states are chained,
and the chunk writes its edits and repaired rows from the state it is in.

Rows lie in order by one range sort, so a conversation of any length spreads
over tasks; a task holds one chunk at a time.  Whether a row repeats an earlier
one is known from the first place of each (role, text), which is aggregated
before the shuffle and found again by place, never by text.  Only the last hash of
a long conversation is sequential by nature: it streams over finished chunks.

Edge cases: a null conv_id is a conversation; a null turn comes first and
counts in no gap; a null role or text is one space; rows of one turn are
ordered by role and text after the damage; an empty role has no initial and
cannot be kept; a conversation without rows left has zeros, an empty audit and
the empty string's hash; very long texts are a chunk of their own at most; an
empty table has no rows; other columns take no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import saved, table

DELETE, INSERT, REROLE, CUT_SHORT = 4, 3, 3, 3  # costs, fixed by the contract
BLANKS, ENDS = " \t\n\x0b\x0c\r", ".!?"  # fixed by the contract
LEGAL = ("su", "ua", "au")  # fixed by the contract
START, SYSTEM, USER, ASSISTANT = range(4)  # what stands last in the repaired rows
AFTER = (USER, USER, ASSISTANT, USER)  # state behind a user or assistant row
NAMES = {USER: "user", ASSISTANT: "assistant"}
#: Way on from each state at the end: nothing, two insertions, one, nothing.
END = bytes([0, 2 * INSERT, INSERT, 0])
TAIL = ("", "II", "I", "")
CHUNK_ROWS, CHUNK_BYTES = 4096, 4 << 20

PIECE = (
    "conv_id long, at long, open boolean, blank long, duplicate long, truncated long, illegal long, first string, last string, "
    "least_turn long, most_turn long, turns long, codes binary, vectors binary, behind binary, roles array<string>, texts array<string>, cost long, audit string, repaired string"
)
_PIECE = pa.schema(
    [
        ("conv_id", pa.int64()), ("at", pa.int64()), ("open", pa.bool_()), *((c, pa.int64()) for c in ("blank", "duplicate", "truncated", "illegal")),
        ("first", pa.string()), ("last", pa.string()), *((c, pa.int64()) for c in ("least_turn", "most_turn", "turns")),
        *((c, pa.binary()) for c in ("codes", "vectors", "behind")), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())),
        ("cost", pa.int64()), ("audit", pa.string()), ("repaired", pa.string()),
    ]
)


def fault(conv_id: str = "conv_id", turn: str = "turn") -> Column:
    """What the contract's damage does to a row: a number below 20."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    return F.crc32(F.concat(part(conv_id), F.lit(":"), part(turn)).cast("binary")) % 20


def damage(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text of the damaged rows; repeated ones twice."""
    d, role, text = F.col("_d"), F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    rows = rows.select("conv_id", "turn", "role", "text", fault().alias("_d"))
    rows = rows.select(
        "conv_id",
        "turn",
        F.when(d == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(d == 1, F.lit("")).when(d == 2, F.translate(text, ENDS, "")).otherwise(text).alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(d == 0, 0).when(d == 3, 2).otherwise(1))).alias("_copy"),
    )
    return rows.drop("_copy")


# One byte a row: initial (0 other, else the state it leads to), then flags.
FORCED, SHORT = 4, 8


def _before(code: int, v: bytes) -> list[int]:
    """Costs before a row from those behind it."""
    kind, extra = code & 3, CUT_SHORT if code & SHORT else 0
    out = []
    for state in range(4):
        ways = [DELETE + v[state]]
        if not code & FORCED:
            ways.append(REROLE + extra + v[AFTER[state]])
            if kind == SYSTEM and state == START or kind in NAMES and kind == AFTER[state]:
                ways.append(extra + v[kind])
        out.append(min(ways))
    user, assistant = out[USER], out[ASSISTANT]
    out[USER], out[ASSISTANT] = min(user, INSERT + assistant), min(assistant, INSERT + user)
    out[START], out[SYSTEM] = min(out[START], INSERT + out[USER]), min(out[SYSTEM], INSERT + out[USER])
    return out


_steps: dict[tuple[int, bytes], bytes] = {}


def step(code: int, v: bytes) -> bytes:
    """The vector before a row, less its least value."""
    found = _steps.get((code, v))
    if found is None:
        out = _before(code, v)
        found = _steps[code, v] = bytes(c - min(out) for c in out)
    return found


def backward(codes: bytes, end: bytes) -> bytes:
    """Vectors before each row of a chunk with ``end`` behind it."""
    out, v = [], end
    for code in reversed(codes):
        v = step(code, v)
        out.append(v)
    return b"".join(reversed(out))


def fix_up(codes: bytes, vectors: bytes, end: bytes) -> bytes:
    """``vectors`` after a change of what stands behind the chunk: rows are run
    again until old and new vector differ only by a constant."""
    out, v, i = [], end, len(codes)
    while i:
        i -= 1
        v = step(codes[i], v)
        if v == vectors[4 * i : 4 * i + 4]:
            i += 1
            break
        out.append(v)
    return vectors[: 4 * i] + b"".join(reversed(out))


_edits: dict[tuple[int, bytes, int], tuple[str, int, int]] = {}


def edits(code: int, v: bytes, state: int) -> tuple[str, int, int]:
    """Least letters among the cheapest for one row, the state behind it and their cost."""
    found = _edits.get((code, v, state))
    if found is None:
        w, kind, extra = _before(code, v), code & 3, CUT_SHORT if code & SHORT else 0
        letters, cost, at = "", 0, state
        while True:
            if w[at] == DELETE + v[at]:
                letters, cost, behind = letters + "D", cost + DELETE, at
            elif w[at] == INSERT + w[AFTER[at]]:
                letters, cost, at = letters + "I", cost + INSERT, AFTER[at]
                continue
            elif (kind == SYSTEM and at == START or kind in NAMES and kind == AFTER[at]) and w[at] == extra + v[kind]:
                letters, cost, behind = letters + "K", cost + extra, kind
            else:
                letters, cost, behind = letters + "R", cost + REROLE + extra, AFTER[at]
            break
        found = _edits[code, v, state] = letters, behind, cost
    return found


def walk(codes: bytes, vectors: bytes, end: bytes, state: int) -> tuple[list[str], int, int]:
    """Letters of each row, the state behind the chunk and the cost, from ``state``."""
    out, cost = [], 0
    for i, code in enumerate(codes):
        letters, state, c = edits(code, vectors[4 * i + 4 : 4 * i + 8] or end, state)
        out.append(letters)
        cost += c
    return out, state, cost


def lines(letters: list[str], roles: list[str], texts: list[str], state: int) -> list[str]:
    """Repaired rows of a chunk that is entered in ``state``."""
    out = []
    for some, role, text in zip(letters, roles, texts):
        for letter in some:
            if letter == "K":
                out.append(f"{role}:{text}")
                state = {"s": SYSTEM, "u": USER, "a": ASSISTANT}[role[0]]
            elif letter != "D":
                state = AFTER[state]
                out.append(f"{NAMES[state]}:{text if letter == 'R' else ''}")
    return out


def tail(state: int) -> list[str]:
    """Rows put in behind the last one."""
    out = []
    for _ in TAIL[state]:
        state = AFTER[state]
        out.append(f"{NAMES[state]}:")
    return out


class _Chunk:
    """Rows of one conversation, as they come."""

    def __init__(self, conv_id: int | None, at: int):
        self.conv_id, self.at, self.size = conv_id, at, 0
        self.codes, self.roles, self.texts, self.turns = bytearray(), [], [], []
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}

    def add(self, turn: int | None, role: str, text: str, first: bool) -> None:
        bare = text.strip(BLANKS)
        flaw = "blank" if not bare else "duplicate" if not first else "truncated" if bare[-1] not in ENDS else None
        if flaw:
            self.counts[flaw] += 1
        if self.roles and self.roles[-1][:1] + role[:1] not in LEGAL:
            self.counts["illegal"] += 1
        kind = {"s": SYSTEM, "u": USER, "a": ASSISTANT}.get(role[:1], 0)
        self.codes.append(kind | (FORCED if flaw in ("blank", "duplicate") else SHORT if flaw else 0))
        self.roles.append(role)
        self.texts.append(text)
        if turn is not None and (not self.turns or self.turns[-1] != turn):
            self.turns.append(turn)
        self.size += len(text) + len(role)

    def row(self, whole: bool) -> dict:
        """Repaired, if this is the whole conversation; otherwise with speculative vectors."""
        codes = bytes(self.codes)
        vectors = backward(codes, END)
        out = {
            "conv_id": self.conv_id, "at": self.at, "open": not whole, **self.counts, "first": self.roles[0][:1], "last": self.roles[-1][:1],
            "least_turn": min(self.turns, default=None), "most_turn": max(self.turns, default=None), "turns": len(self.turns),
        }
        if not whole:
            return out | {"codes": codes, "vectors": vectors, "behind": END, "roles": self.roles, "texts": self.texts}
        letters, state, cost = walk(codes, vectors, END, START)
        rows = lines(letters, self.roles, self.texts, START) + tail(state)
        return out | {"cost": cost + INSERT * len(TAIL[state]), "audit": "".join(letters) + TAIL[state], "repaired": "\n".join(rows)}


def _table(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks of rows in order of place, marks of first places among them.

    A conversation that begins and ends inside one sorted run and fits a
    chunk is whole; what touches an end of a run may go on in another."""
    done: list[dict] = []
    chunk, part, closed, marked = None, None, False, None
    held = 0

    def flush(whole: bool) -> None:
        nonlocal held
        done.append(chunk.row(whole))
        held += chunk.size + 1

    for batch in batches:
        cols = {c: batch.column(c).to_pylist() for c in ("at", "conv_id", "turn", "role", "text", "mark")}
        for at, conv_id, turn, role, text, mark in zip(*cols.values()):
            if mark:
                marked = at
                continue
            if at >> 33 != part:
                if chunk:
                    flush(False)
                chunk, part, closed = None, at >> 33, False
            if chunk and chunk.conv_id != conv_id:
                flush(closed)
                chunk, closed = None, True
            elif chunk and (len(chunk.codes) >= CHUNK_ROWS or chunk.size >= CHUNK_BYTES):
                flush(False)
                chunk, closed = None, False
            chunk = chunk or _Chunk(conv_id, at)
            chunk.add(turn, role, text, marked == at)
            if held > 1 << 22 or len(done) > 8192:
                yield _table(done, _PIECE)
                done, held = [], 0
    if chunk:
        flush(False)
    yield _table(done, _PIECE)


def pieces(rows: DataFrame) -> DataFrame:
    """Written chunks of ordered ``rows`` (conv_id, turn, role, text)."""
    keys = ("conv_id", "turn", "role")
    ranged = rows.repartitionByRange(*keys, F.substring("text", 1, 32)).sortWithinPartitions(*keys, "text")
    ordered = saved(ranged.withColumn("at", F.monotonically_increasing_id()), "turns")
    firsts = ordered.groupBy("conv_id", "role", F.sha2(F.col("text").cast("binary"), 256)).agg(F.min("at").alias("at")).select("at", F.lit(True).alias("mark"))
    merged = ordered.withColumn("mark", F.lit(False)).unionByName(firsts, allowMissingColumns=True)
    run = F.shiftright("at", 33)
    ordered_again = merged.repartition(run).sortWithinPartitions("at", F.desc("mark"))
    return saved(ordered_again.mapInArrow(_chunks, PIECE), "turn-chunks")


def converge(chunks: DataFrame) -> DataFrame:
    """Fix-up passes over chunks (conv_id, at, codes, vectors, behind) until
    every chunk ran with its successor's vector."""

    @F.arrow_udf("binary")
    def again(codes, vectors, behind):
        return pa.array([fix_up(*x) for x in zip(codes.to_pylist(), vectors.to_pylist(), behind.to_pylist())], pa.binary())

    following = F.lead(F.substring("vectors", 1, 4)).over(Window.partitionBy("conv_id").orderBy("at"))
    while True:
        # One row per chunk meets its successor; a chunk holds thousands of rows.
        wanted = chunks.select("conv_id", "at", "behind", "vectors").withColumn("wanted", F.coalesce(following, F.lit(END)))
        late = saved(wanted.where(F.col("wanted") != F.col("behind")).select(F.col("at").alias("_at"), "wanted"), "turn-late")
        if late.isEmpty():
            return chunks
        joined = chunks.join(late, chunks["at"] == late["_at"], "left")
        fixed = F.when(F.col("wanted").isNull(), F.col("vectors")).otherwise(again("codes", "vectors", F.coalesce("wanted", "behind")))
        chunks = saved(joined.select("conv_id", "at", "codes", fixed.alias("vectors"), F.coalesce("wanted", "behind").alias("behind")), "turn-vectors")


def _states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chain of states over chunks in order: the one that each is entered in."""
    now, state = object(), START
    for batch in batches:
        out = []
        cols = (batch.column(c).to_pylist() for c in ("conv_id", "at", "exits", "final"))
        for conv_id, at, exits, final in zip(*cols):
            if conv_id != now:
                now, state = conv_id, START
            out.append({"_at": at, "entered": state, "final": final})
            state = exits[state]
        yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("_at", pa.int64()), ("entered", pa.int32()), ("final", pa.bool_())]))


def _written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edits and repaired rows of chunks from the state they are entered in."""
    schema = pa.schema([("at", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()), ("repaired", pa.string())])
    for batch in batches:
        for i in range(batch.num_rows):
            r = batch.slice(i, 1).to_pylist()[0]
            letters, state, cost = walk(r["codes"], r["vectors"], r["behind"], r["entered"])
            rows = lines(letters, r["roles"], r["texts"], r["entered"])
            more = TAIL[state] if r["final"] else ""
            rows += tail(state) if more else []
            yield _table([{"at": r["at"], "cost": cost + INSERT * len(more), "audit": "".join(letters) + more, "repaired": "\n".join(rows)}], schema)


def repair(rows: DataFrame) -> DataFrame:
    """Pieces of repaired conversations: conv_id, at (ascending within a
    conversation), open (is there more than this piece?), the piece's
    faults, cost, audit and repaired ``role:text`` lines."""
    found = pieces(rows)
    chunks = converge(found.where("open").select("conv_id", "at", "codes", "vectors", "behind"))

    @F.arrow_udf("array<int>")
    def exits(codes, vectors, behind):
        every = zip(codes.to_pylist(), vectors.to_pylist(), behind.to_pylist())
        return pa.array([[walk(*x, state)[1] for state in range(4)] for x in every], pa.list_(pa.int32()))

    follows = F.lead("at").over(Window.partitionBy("conv_id").orderBy("at"))
    ends = saved(chunks.select("conv_id", "at", exits("codes", "vectors", "behind").alias("exits"), follows.isNull().alias("final")), "turn-exits")
    entered = ends.repartition("conv_id").sortWithinPartitions("conv_id", "at").mapInArrow(_states, "_at long, entered int, final boolean")
    texts = found.where("open").select(F.col("at").alias("_at"), "roles", "texts")
    walked = chunks.join(entered, chunks["at"] == entered["_at"]).drop("_at").join(texts, F.col("at") == F.col("_at")).select("at", "codes", "vectors", "behind", "entered", "final", "roles", "texts")
    written = walked.mapInArrow(_written, "at long, cost long, audit string, repaired string")
    stats = ["conv_id", "at", "open", "blank", "duplicate", "truncated", "illegal", "first", "last", "least_turn", "most_turn", "turns"]
    done = found.where(~F.col("open")).select(*stats, "cost", "audit", "repaired")
    return done.unionByName(found.where("open").select(*stats).join(written, "at"))


REPORT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation from its pieces in order."""
    import hashlib

    schema = pa.schema([("conv_id", pa.int64()), *((c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")), ("audit", pa.string()), ("repaired_sha256", pa.string())])
    now = None

    def row() -> pa.RecordBatch:
        least, most, turns = now["span"]
        out = {k: now[k] for k in ("conv_id", "blank", "duplicate", "truncated", "illegal", "cost")}
        return _table([out | {"gaps": most - least + 1 - turns if turns else 0, "audit": "".join(now["audit"]), "repaired_sha256": now["hash"].hexdigest()}], schema)

    for batch in batches:
        for i in range(batch.num_rows):
            r = batch.slice(i, 1).to_pylist()[0]
            if now is None or now["conv_id"] != r["conv_id"]:
                if now:
                    yield row()
                now = {"conv_id": r["conv_id"], "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "cost": 0, "audit": [], "hash": hashlib.sha256(), "any": False, "span": (0, 0, 0), "last": None}
            for k in ("blank", "duplicate", "truncated", "illegal", "cost"):
                now[k] += r[k]
            now["illegal"] += now["last"] is not None and now["last"] + r["first"] not in LEGAL
            now["last"] = r["last"]
            least, most, turns = now["span"]
            if r["turns"]:
                same = turns > 0 and most == r["least_turn"]
                now["span"] = (least if turns else r["least_turn"], r["most_turn"], turns + r["turns"] - same)
            now["audit"].append(r["audit"])
            if r["repaired"]:
                now["hash"].update((b"\n" if now["any"] else b"") + r["repaired"].encode())
                now["any"] = True
    if now:
        yield row()


def report(repaired: DataFrame) -> DataFrame:
    """Counts, cost, audit and hash of each conversation of ``repair``."""
    gaps = F.when(F.col("turns") > 0, F.col("most_turn") - F.col("least_turn") + 1 - F.col("turns")).otherwise(0)
    whole = repaired.where(~F.col("open")).select("conv_id", gaps.cast("long").alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit", F.sha2(F.col("repaired").cast("binary"), 256).alias("repaired_sha256"))
    several = repaired.where("open").repartition("conv_id").sortWithinPartitions("conv_id", "at").mapInArrow(_report, REPORT)
    return whole.unionByName(several)


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    gone = rows.groupBy("conv_id").agg(F.max(fault()).alias("_d")).where("_d = 0").select("conv_id")
    nothing = [F.lit(0).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    emptied = gone.select("conv_id", *nothing, F.lit("").alias("audit"), F.sha2(F.lit("").cast("binary"), 256).alias("repaired_sha256"))
    return report(repair(damage(rows))).unionByName(emptied)


_CRC = """xor(list_reduce(list_concat([4294967295], flatten(list_transform(string_split(coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' '), ''),
    lambda c: [cast(ascii(c) as bigint), -1, -1, -1, -1, -1, -1, -1, -1]))), lambda a, x: case when x >= 0 then xor(a, x) else xor(a >> 1, 3988292384 * (a & 1)) end), 4294967295)"""

_BARE = r"regexp_replace(text, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g')"


def _sql() -> str:
    """Forward costs: per row and state the least (cost, letters) with the repaired lines."""
    put = lambda s, name: f"struct_pack(c := {s}.c + 3, a := {s}.a || 'I', t := {s}.t || chr(10) || '{name}:')"
    drop = lambda s: f"struct_pack(c := {s}.c + 4, a := {s}.a || 'D', t := {s}.t)"
    keep = lambda s: f"struct_pack(c := {s}.c + extra, a := {s}.a || 'K', t := {s}.t || chr(10) || role || ':' || text)"
    name = lambda s, to: f"struct_pack(c := {s}.c + 3 + extra, a := {s}.a || 'R', t := {s}.t || chr(10) || '{to}:' || text)"
    where = lambda test, way: f"case when {test} then {way} end"
    ways = {
        0: [drop("s0")],
        1: [drop("s1"), where("not forced and kind = 's'", keep("s0"))],
        2: [drop("s2")] + [where("not forced and kind = 'u'", keep(s)) for s in ("s0", "s1", "s3")] + [where("not forced", name(s, "user")) for s in ("s0", "s1", "s3")],
        3: [drop("s3"), where("not forced and kind = 'a'", keep("s2")), where("not forced", name("s2", "assistant"))],
    }
    least = lambda some: f"list_min(list_filter([{', '.join(some)}], lambda w: w is not null and w.c is not null))"
    stepped = ", ".join(f"{least(w)} as r{k}" for k, w in ways.items())
    return rf"""
with recursive turns as (
  select conv_id, turn, case when d = 4 then 'user' else coalesce(role, ' ') end as role,
    case when d = 1 then '' when d = 2 then regexp_replace(coalesce(text, ' '), '[.!?]', '', 'g') else coalesce(text, ' ') end as text, copy
  from (select *, {_CRC} % 20 as d from conversations), (values (1), (2)) as twice(copy)
  where d <> 0 and (copy = 1 or d = 3)),
placed as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, text, copy) as i,
    row_number() over (partition by conv_id, role, text order by turn nulls first, copy) > 1 as again, left(role, 1) as kind, {_BARE} as bare
  from turns),
flawed as (
  select *, bare = '' as is_blank, bare <> '' and again as is_again, bare <> '' and not again and right(bare, 1) not in ('.', '!', '?') as is_short,
    lag(kind) over (partition by conv_id order by i) as prior
  from placed),
coded as (select conv_id, i, role, text, kind, is_blank or is_again as forced, case when is_short then 3 else 0 end as extra, count(*) over (partition by conv_id) as n from flawed),
counts as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (is_blank) as blank, count(*) filter (is_again) as duplicate,
    count(*) filter (is_short) as truncated, count(*) filter (prior is not null and prior || kind not in ('su', 'ua', 'au')) as illegal
  from flawed group by conv_id),
state as (
  select conv_id, cast(0 as bigint) as i, any_value(n) as n, struct_pack(c := cast(0 as bigint), a := '', t := '') as s0,
    cast(null as struct(c bigint, a varchar, t varchar)) as s1, struct_pack(c := cast(3 as bigint), a := 'I', t := chr(10) || 'user:') as s2,
    struct_pack(c := cast(6 as bigint), a := 'II', t := chr(10) || 'user:' || chr(10) || 'assistant:') as s3
  from coded group by conv_id
  union all
  select conv_id, i, n, r0 as s0, r1 as s1, q2 as s2, {least(["r3", put("q2", "assistant")])} as s3
  from (select *, {least(["r2", put("r0", "user"), put("r1", "user"), put("r3", "user")])} as q2
        from (select s.conv_id, s.i + 1 as i, s.n, {stepped} from state s join coded k on s.conv_id is not distinct from k.conv_id and s.i + 1 = k.i))),
best as (select conv_id, {least(["s0", "s3"])} as best from state where i = n)
select o.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal,
  coalesce(best.c, 0) as cost, coalesce(best.a, '') as audit, sha256(coalesce(substr(best.t, 2), '')) as repaired_sha256
from (select distinct conv_id from conversations) o left join counts c on o.conv_id is not distinct from c.conv_id left join best b on o.conv_id is not distinct from b.conv_id
"""


OP11_SQL = _sql()
