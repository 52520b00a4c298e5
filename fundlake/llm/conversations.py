"""Repair of conversation structure by a run-length dynamic programme.

A conversation has the right structure if the initials of its roles read ``(s?(ua)+)?``. Rows are kept, given another
role, deleted, or inserted, each at a price, and the cheapest list of edits is wanted; of equally cheap ones the one whose
letters come first in ASCII.

Every row is one symbol: its role and its fault. What a symbol does to the four states (nothing yet, after s, after u,
after a) is a min-plus matrix. Equal symbols in a row are one run, and a run of any length is a few products of cached
binary powers of its matrix. Conversations are cut into chunks of ``CHUNK`` rows: each chunk becomes one matrix, the
matrices are scanned backwards for the price of what follows each chunk, then each chunk becomes a map from the state
before it to the state after it, and these are scanned forwards. Now every chunk knows both ends and unrolls its own
choices into edits. So no task holds more than a chunk of rows, or ``FAN`` chunk summaries, however long a conversation
is. The digest of the repaired text is of one sequence of bytes; rows stream through it in order and are not kept.

Defined results: a null conv_id is a conversation of its own; null roles and texts are one space; rows of one turn are
ordered by the digest of role and text, null turns first; conversations without rows after damage have zeros, an empty
audit and the digest of nothing; a number of gaps beyond a long is the largest long; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache
from hashlib import sha256
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlake.llm.common import prepare, read, stage
from fundlake.llm.merkle import CRC, CRC_TABLE
from fundlake.llm.ranking import numbered

CHUNK, FAN = 4096, 1024
NEVER = 1 << 60
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: States: 0 nothing yet, 1 after s, 2 after u, 3 after a. The role that may be given or inserted, and where it leads.
GIVEN = ("u", "u", "a", "u")
LEADS = (2, 2, 3, 2)
KEPT = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
#: Price of ending in each state: insert what is missing.
END = (0, 2 * INSERT, INSERT, 0)
ROLES = {"u": "user", "a": "assistant"}
#: Row that must go; other symbols are s, u, a, or x for other roles, in capitals where the text is truncated.
GONE = "d"

Matrix = tuple[tuple[int, ...], ...]


def choices(symbol: str, state: int) -> list[tuple[str, int, int]]:
    """Letter, price and next state of what can be done with a row, in ASCII order of the letters."""
    found = [("D", DELETE, state)]
    if symbol != GONE:
        extra = TRUNCATED if symbol.isupper() else 0
        kept = KEPT.get(symbol.lower(), {}).get(state)
        found += [("K", extra, kept)] if kept is not None else []
        found += [("R", REROLE + extra, LEADS[state])]
    return found


def then(first: Matrix, second: Matrix) -> Matrix:
    """Min-plus product: the prices of ``first`` and ``second`` one after the other."""
    columns = tuple(zip(*second, strict=True))
    return tuple(tuple(min(NEVER, *(a + b for a, b in zip(row, column, strict=True))) for column in columns) for row in first)


def before(matrix: Matrix, after: tuple[int, ...]) -> tuple[int, ...]:
    """Price from each state of going through ``matrix`` and then of what ``after`` says of the states behind it."""
    return tuple(min(NEVER, *(a + b for a, b in zip(row, after, strict=True))) for row in matrix)


@lru_cache(maxsize=None)
def power(symbol: str, k: int) -> Matrix:
    """The matrix of 2**k rows with this symbol. There are nine symbols, and k stays below 64."""
    if k:
        return then(power(symbol, k - 1), power(symbol, k - 1))
    rows = []
    for state in range(4):
        prices, at = [NEVER] * 4, state
        for paid in (0, INSERT, 2 * INSERT):  # a third insertion leads where the first did
            for _, price, reached in choices(symbol, at):
                prices[reached] = min(prices[reached], paid + price)
            at = LEADS[at]
        rows.append(tuple(prices))
    return tuple(rows)


def runs(symbols: str) -> list[tuple[str, int]]:
    return [(symbol, len(list(same))) for symbol, same in groupby(symbols)]


def _powers(symbol: str, length: int) -> Iterator[Matrix]:
    return (power(symbol, k) for k in range(length.bit_length()) if length >> k & 1)


def matrix_of(symbols: str) -> Matrix:
    """The min-plus matrix of a chunk, run by run."""
    total = tuple(tuple(0 if i == j else NEVER for j in range(4)) for i in range(4))
    for symbol, length in runs(symbols):
        for matrix in _powers(symbol, length):
            total = then(total, matrix)
    return total


def unroll(symbols: str, after: tuple[int, ...], state: int, last: bool) -> tuple[list[str], int]:
    """Edits of each row of a chunk from ``state`` on, and the state behind it. An edit is letters each with its role:
    ``IuKa`` inserts a user row before a kept one. In the last chunk the missing rows follow the last row's own edit."""
    ends = [after]  # prices behind each run, from the last run to the first
    for symbol, length in reversed(runs(symbols)[1:]):
        price = ends[-1]
        for matrix in _powers(symbol, length):
            price = before(matrix, price)
        ends.append(price)
    edits = []
    for symbol, length in runs(symbols):
        steps = [ends.pop()]
        for _ in range(length):
            steps.append(before(power(symbol, 0), steps[-1]))
        for k in range(length, 0, -1):
            edit, here, behind = "", steps[k], steps[k - 1]
            while True:
                # The first letter that keeps the price: D, then I, then K, then R.
                fits = [(x, to) for x, price, to in choices(symbol, state) if price + behind[to] == here[state]]
                if fits and fits[0][0] == "D":
                    edit += "D-"
                    break
                if INSERT + here[LEADS[state]] == here[state]:
                    edit, state = edit + "I" + GIVEN[state], LEADS[state]
                    continue
                letter, reached = fits[0]
                edit, state = edit + letter + (GIVEN[state] if letter == "R" else "-"), reached
                break
            edits.append(edit)
    while last and END[state]:
        edits[-1], state = edits[-1] + "I" + GIVEN[state], LEADS[state]
    return edits, state


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with faults planted by the CRC-32 of ``conv_id:turn``, modulo 20: 0 drops a row, 1 empties its text, 2 removes
    its full stops, exclamation and question marks, 3 repeats it, 4 makes its role user. Nulls are one space."""
    text_of = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    code = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", text_of("role").alias("role"), text_of("text").alias("text"), code.alias("code"))
    return rows.where("code != 0").select(
        "conv_id", "turn", F.when(F.col("code") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("code") == 1, "").when(F.col("code") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("code") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def _ordered(rows: DataFrame) -> DataFrame:
    """Rows with their conversation as text that is not null, their place in it, what they say, and two of the faults."""
    conv = F.when(F.col("conv_id").isNull(), "").otherwise(F.concat(F.lit("="), F.col("conv_id").cast("string")))
    role, text = (F.coalesce(F.col(name).cast("string"), F.lit(" ")) for name in ("role", "text"))
    said = rows.select(conv.alias("conv"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text")).select(
        "*", F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary"), 256).alias("said"),
        (~F.col("text").rlike(r"[^\x20\x09-\x0D]")).alias("blank"),
        (~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("truncated"),
    )
    return numbered(said, "conv", "turn", "said")


def _chunks(rows: DataFrame, chunk: int) -> DataFrame:
    """The symbols of every chunk as one text: conv, at (number of the chunk), count (of chunks), symbols."""
    # The first row that says something is known by its place, so the join that finds it has no frequent key.
    firsts = rows.where("not blank").groupBy("conv", "said").agg(F.min("place").alias("place")).select("conv", "place", F.lit(True).alias("first"))
    initial = F.substring("role", 1, 1)
    plain = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    symbol = (
        F.when(F.col("first").isNull(), GONE).when(F.col("truncated"), F.upper(plain)).otherwise(plain)
    )
    marked = rows.select("conv", "place", "size", "role", "truncated").join(firsts, ["conv", "place"], "left")
    listed = marked.select("conv", F.expr(f"place div {chunk}L").alias("at"), "size", F.struct("place", symbol.alias("symbol")).alias("row"))
    grouped = listed.groupBy("conv", "at").agg(F.first("size").alias("size"), F.sort_array(F.collect_list("row")).alias("rows"))
    symbols = F.array_join(F.col("rows.symbol"), "")
    return stage(grouped.select("conv", "at", F.expr(f"(size + {chunk - 1}L) div {chunk}L").alias("count"), symbols.alias("symbols")), "chunks")


def scan(
    parts: DataFrame, compose: Callable[[list, list], list], apply: Callable[[list, list], list], start: list[int], fan: int = FAN,
) -> DataFrame:
    """``conv``, ``at`` and ``value``: what the steps of all parts of the conversation before ``at`` make of ``start``.

    ``parts`` has conv, at (from 0), count (of parts in the conversation) and step, a list of numbers. ``compose(a, b)`` is
    the step that does a, then b. At most ``fan`` parts are in one task; beyond that they are composed and scanned first.
    """
    longest = parts.agg(F.max("count")).first()[0] or 0
    cut = parts.withColumn("super", F.expr(f"at div {fan}L"))
    if longest <= fan:
        begun = cut.withColumn("begin", F.array(*(F.lit(x).cast("long") for x in start)))
    else:

        def composed(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
            rows = sorted(table.to_pylist(), key=lambda row: row["at"])
            step = rows[0]["step"]
            for row in rows[1:]:
                step = compose(step, row["step"])
            count = -(-rows[0]["count"] // fan)
            return pa.table({"conv": [rows[0]["conv"]], "at": [rows[0]["super"]], "count": [count], "step": pa.array([step], pa.list_(pa.int64()))})

        supers = cut.groupBy("conv", "super").applyInArrow(composed, "conv string, at long, count long, step array<long>")
        above = scan(stage(supers, "supers"), compose, apply, start, fan)
        begun = cut.join(above.select("conv", F.col("at").alias("super"), F.col("value").alias("begin")), ["conv", "super"])

    def stepped(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda row: row["at"])
        values, value = [], rows[0]["begin"]
        for row in rows:
            values.append(value)
            value = apply(row["step"], value)
        return pa.table({"conv": [r["conv"] for r in rows], "at": [r["at"] for r in rows], "value": pa.array(values, pa.list_(pa.int64()))})

    return begun.groupBy("conv", "super").applyInArrow(stepped, "conv string, at long, value array<long>")


def _square(flat: list[int]) -> Matrix:
    return tuple(tuple(flat[i : i + 4]) for i in range(0, 16, 4))


def _per_row(df: DataFrame, kinds: str, compute: Callable[[dict], dict]) -> DataFrame:
    """``df`` with what ``compute`` makes of each row; ``kinds`` are the columns it returns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [compute(row) for row in batch.to_pylist()]
            yield pa.RecordBatch.from_pylist(found, schema=schema)

    names = {"string": pa.string(), "long": pa.int64(), "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}
    schema = pa.schema([(name, names[kind]) for name, kind in (field.split() for field in kinds.split(", "))])
    return df.mapInArrow(run, kinds)


def _edits(chunks: DataFrame, fan: int) -> DataFrame:
    """``chunks`` with the edits of each row."""
    several = chunks.where("count > 1")
    # Backwards: the price of all that follows a chunk. Chunks are numbered from the end for that.
    steps = _per_row(
        several.select("conv", F.expr("count - 1 - at").alias("at"), "count", "symbols"), "conv string, at long, count long, step array<long>",
        lambda row: {k: row[k] for k in ("conv", "at", "count")} | {"step": [x for line in matrix_of(row["symbols"]) for x in line]},
    )
    follows = scan(
        stage(steps, "matrices"), lambda a, b: [x for line in then(_square(b), _square(a)) for x in line],
        lambda step, value: list(before(_square(step), tuple(value))), list(END), fan,
    )
    follows = follows.select("conv", F.col("at").alias("from_end"), F.col("value").alias("after"))
    priced = stage(several.withColumn("from_end", F.expr("count - 1 - at")).join(follows, ["conv", "from_end"]).drop("from_end"), "prices")
    # Forwards: the state before a chunk.
    maps = _per_row(
        priced, "conv string, at long, count long, step array<long>",
        lambda row: {k: row[k] for k in ("conv", "at", "count")} | {"step": [unroll(row["symbols"], tuple(row["after"]), q, False)[1] for q in range(4)]},
    )
    states = scan(stage(maps, "maps"), lambda a, b: [b[q] for q in a], lambda step, value: [step[value[0]]], [0], fan)
    known = priced.join(states.select("conv", "at", F.col("value").alias("state")), ["conv", "at"])
    lone = chunks.where("count = 1").withColumn("after", F.array(*(F.lit(x).cast("long") for x in END))).withColumn("state", F.array(F.lit(0).cast("long")))
    return _per_row(
        known.unionByName(lone), "conv string, at long, symbols string, edits array<string>",
        lambda row: {k: row[k] for k in ("conv", "at", "symbols")} | {"edits": unroll(row["symbols"], tuple(row["after"]), row["state"][0], row["at"] == row["count"] - 1)[0]},
    )


class _Repaired:
    """What is known of a conversation after some of its rows; no row is kept."""

    def __init__(self, conv: str):
        self.conv, self.audit, self.cost, self.empty = conv, [], 0, True
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.turn = self.least = self.initial = None
        self.hash = sha256()

    def line(self, role: str, text: str) -> None:
        self.hash.update(("" if self.empty else "\n").encode() + f"{role}:{text}".encode())
        self.empty = False

    def add(self, row: dict, symbol: str, edit: str) -> None:
        turn, initial = row["turn"], row["role"][:1]
        if turn is not None and turn != self.turn:
            self.turns, self.turn, self.least = self.turns + 1, turn, turn if self.least is None else self.least
        self.illegal += self.initial is not None and self.initial + initial not in ("su", "ua", "au")
        self.initial = initial
        self.blank += row["blank"]
        self.duplicate += symbol == GONE and not row["blank"]
        self.truncated += symbol.isupper()
        self.audit.append(edit[::2])
        for letter, role in zip(edit[::2], edit[1::2], strict=True):
            self.cost += {"D": DELETE, "I": INSERT, "K": 0, "R": REROLE}[letter] + (TRUNCATED if letter in "KR" and symbol.isupper() else 0)
            if letter == "I":
                self.line(ROLES[role], "")
            elif letter != "D":
                self.line(ROLES[role] if letter == "R" else row["role"], row["text"])

    def result(self) -> dict:
        gaps = min(2**63 - 1, self.turn - self.least + 1 - self.turns) if self.turns else 0
        return {
            "conv": self.conv, "gaps": gaps, "blank": self.blank, "duplicate": self.duplicate, "truncated": self.truncated,
            "illegal": self.illegal, "cost": self.cost, "audit": "".join(self.audit), "repaired_sha256": self.hash.hexdigest(),
        }


RESULT = "conv string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def repair(conversations: DataFrame, chunk: int = CHUNK, fan: int = FAN) -> DataFrame:
    """Faults, cheapest edits and digest of the repaired text of each conversation (conv_id, turn, role, text) with rows:
    conv (``=`` and the id, or empty for a null id), gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
    prepare(conversations.sparkSession)
    rows = _ordered(conversations)
    edits = _edits(_chunks(rows, chunk), fan)
    told = rows.select("conv", "place", F.lit(1).alias("kind"), "turn", "role", "text", "blank")
    plan = edits.select("conv", (F.col("at") * chunk).alias("place"), F.lit(0).alias("kind"), "symbols", "edits")
    # The edits of a chunk come just before its rows.
    both = told.unionByName(plan, allowMissingColumns=True).repartition("conv").sortWithinPartitions("conv", "place", "kind")

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, chunk_plan, done = None, None, []
        for batch in batches:
            for row in batch.to_pylist():
                if held is None or row["conv"] != held.conv:
                    if held is not None:
                        done.append(held.result())
                    held = _Repaired(row["conv"])
                if row["kind"] == 0:
                    chunk_plan = row
                else:
                    k = row["place"] - chunk_plan["place"]
                    held.add(row, chunk_plan["symbols"][k], chunk_plan["edits"][k])
            if done:
                yield pa.RecordBatch.from_pylist(done, schema=schema)
                done = []
        if held is not None:
            yield pa.RecordBatch.from_pylist([held.result()], schema=schema)

    fields = [field.split() for field in RESULT.split(", ")]
    schema = pa.schema([(name, pa.string() if kind == "string" else pa.int64()) for name, kind in fields])
    return both.mapInArrow(stream, RESULT)


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations", conv_id="long", turn="long", role="string", text="string")
    found = repair(damaged(rows))
    every = rows.select(F.when(F.col("conv_id").isNull(), "").otherwise(F.concat(F.lit("="), F.col("conv_id").cast("string"))).alias("conv")).distinct()
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return every.join(found, "conv", "left").select(
        F.when(F.col("conv") != "", F.substring("conv", 2, 20)).cast("long").alias("conv_id"),
        *(F.coalesce(name, F.lit(0)).cast("long").alias(name) for name in counts),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(sha256().hexdigest())).alias("repaired_sha256"),
    )


SQL = f"""with recursive {CRC_TABLE},
coded as (select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
  {CRC.format("(coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '))")} % 20 as code from conversations, crc),
damaged as (
  select conv_id, turn, case when code = 4 then 'user' else role end as role,
    case when code = 1 then '' when code = 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text
  from coded, range(2) c(copy) where code <> 0 and (copy = 0 or code = 3)),
placed as (select *, row_number() over (partition by conv_id order by turn nulls first, sha256(strlen(role) || ':' || role || text)) - 1 as i,
  not regexp_matches(text, '[^\\x20\\x09-\\x0D]') as blank, not regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') as open from damaged),
faults as (select *, not blank and row_number() over (partition by conv_id, role, text order by i) > 1 as duplicate,
  lag(left(role, 1)) over (partition by conv_id order by i) || left(role, 1) as pair from placed),
symbols as (select conv_id, i, role, text, left(role, 1) as r, blank or duplicate as gone, case when open then 5 else 0 end as p from faults),
prices(conv_id, i, v0, v1, v2, v3) as (
  select conv_id, count(*), 0, 10, 5, 0 from symbols group by conv_id
  union all
  select conv_id, i, least(o0, 5 + o2, 10 + o3), least(o1, 5 + o2, 10 + o3), least(o2, 5 + o3), least(o3, 5 + o2) from (
    select s.conv_id, s.i,
      least(2 + v0, case when gone then 2 + v0 when r = 's' then least(v1, 1 + v2) + p when r = 'u' then v2 + p else 1 + v2 + p end) as o0,
      least(2 + v1, case when gone then 2 + v1 when r = 'u' then v2 + p else 1 + v2 + p end) as o1,
      least(2 + v2, case when gone then 2 + v2 when r = 'a' then v3 + p else 1 + v3 + p end) as o2,
      least(2 + v3, case when gone then 2 + v3 when r = 'u' then v2 + p else 1 + v2 + p end) as o3
    from prices v join symbols s on s.conv_id is not distinct from v.conv_id and s.i = v.i - 1)),
walks(conv_id, i, q, audit, said, done) as (
  select conv_id, 0, 0, '', null::varchar, false from symbols where i = 0
  union all
  select conv_id, case letter when 'I' then i when 'E' then i else i + 1 end,
    case letter when 'D' then q when 'E' then q when 'K' then case r when 's' then 1 when 'u' then 2 else 3 end else given end,
    case letter when 'E' then audit else audit || letter end,
    case letter when 'D' then said when 'E' then said else coalesce(said || chr(10), '') || case letter when 'K' then role || ':' || text
      when 'R' then new_role || ':' || text else new_role || ':' end end, letter = 'E'
  from (select *, case
      when r is null then case when q in (0, 3) then 'E' else 'I' end
      when 2 + next[q + 1] = here[q + 1] then 'D' when 5 + here[given + 1] = here[q + 1] then 'I'
      when r = 's' and q = 0 and p + next[2] = here[1] then 'K'
      when r = 'u' and q <> 2 and p + next[3] = here[q + 1] then 'K' when r = 'a' and q = 2 and p + next[4] = here[3] then 'K' else 'R' end as letter
    from (select w.*, s.r, s.role, s.text, s.p, case when q = 2 then 3 else 2 end as given, case when q = 2 then 'assistant' else 'user' end as new_role,
        [h.v0, h.v1, h.v2, h.v3] as here, [n.v0, n.v1, n.v2, n.v3] as next
      from walks w left join symbols s on s.conv_id is not distinct from w.conv_id and s.i = w.i
      left join prices h on h.conv_id is not distinct from w.conv_id and h.i = w.i
      left join prices n on n.conv_id is not distinct from w.conv_id and n.i = w.i + 1 where not w.done))),
counts as (select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (blank) as blank,
  count(*) filter (duplicate) as duplicate, count(*) filter (open and not blank and not duplicate) as truncated,
  count(*) filter (pair is not null and pair not in ('su', 'ua', 'au')) as illegal from faults group by conv_id)
select o.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank, coalesce(duplicate, 0)::bigint as duplicate,
  coalesce(truncated, 0)::bigint as truncated, coalesce(illegal, 0)::bigint as illegal, coalesce(v0, 0)::bigint as cost,
  coalesce(audit, '') as audit, sha256(coalesce(said, '')) as repaired_sha256
from (select distinct conv_id from conversations) o left join counts c on c.conv_id is not distinct from o.conv_id
left join walks w on w.conv_id is not distinct from o.conv_id and w.done
left join prices v on v.conv_id is not distinct from o.conv_id and v.i = 0"""
