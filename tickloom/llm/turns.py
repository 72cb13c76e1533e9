"""Conversation structure repair: cheapest edits by a grammar-compressed dynamic program.

Every row of a conversation becomes one of nine symbols: its role (system, user, assistant,
other) sound or truncated, or a row that has to go. Repair is a shortest path over four states
of the pattern ``(s?(ua)+)?``. A symbol's edits are a 4 x 4 matrix of (cost, audit), a sequence
is the min-plus product of its symbols' matrices, and the product is associative. So the
symbol sequences of all conversations are compressed with one Re-Pair grammar, each rule's
matrix is the product of its two parts, evaluated bottom-up once, and a conversation is a
row vector times the matrices of its compressed sequence.

Audits are ropes: a rule's audit is a pair of its parts' audits and is written out only at the
end. Equal costs go to the lesser audit; two audits of one sequence and equal cost never
extend each other (the longer one would hold more inserts), so the choice survives products.

Keys, not texts, move to order and judge the rows; texts move once, for the repaired hash. That
hash and the audit are defined row after row, so one task reads a conversation; it does so as a
stream and keeps the audit (a byte per row), never the rows.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import parts, ship, stage

#: Rows of one block of a sequence. It only splits the work.
BLOCK = 256
#: The grammar ends with these rules or rounds, or when a round saves less than that share of
#: all symbols. A longer grammar would change no result.
MOST_RULES = 2_048
MOST_ROUNDS = 12
LEAST_SAVED = 0.01

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
USER, ASSISTANT = "user", "assistant"
_STATES = range(4)
#: start, after s, after u, after ua; missing moves leave the pattern.
_MOVES = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
_ACCEPTED = (0, 3)
_SYMBOLS = "suaoSUAOd"
_FIRST_RULE = 0x4E00

Rope = str | tuple
Entry = tuple[int, Rope]
Matrix = list[list[Entry | None]]


# The program ------------------------------------------------------------------------


def leaves(rope: Rope) -> Iterator[str]:
    """Strings of a rope, from the left."""
    stack = [rope]
    while stack:
        top = stack.pop()
        if isinstance(top, tuple):
            stack += reversed(top)
        elif top:
            yield top


def text_of(rope: Rope) -> str:
    return "".join(leaves(rope))


def precedes(one: Rope, other: Rope) -> bool:
    """Whether rope ``one`` is less than ``other``; reads no further than they agree."""
    if one is other:
        return False
    left, right = leaves(one), leaves(other)
    a = b = ""
    while True:
        a, b = a or next(left, ""), b or next(right, "")
        n = min(len(a), len(b))
        if n == 0 or a[:n] != b[:n]:
            return a < b
        a, b = a[n:], b[n:]


def better(one: Entry | None, other: Entry | None) -> Entry | None:
    if one is None or other is None:
        return one or other
    if one[0] != other[0]:
        return one if one[0] < other[0] else other
    return one if precedes(one[1], other[1]) else other


def then(one: Entry | None, other: Entry | None) -> Entry | None:
    if one is None or other is None:
        return None
    return one[0] + other[0], (one[1], other[1])


def row_times(vector: list[Entry | None], matrix: Matrix) -> list[Entry | None]:
    out: list[Entry | None] = [None] * len(_STATES)
    for i, entry in enumerate(vector):
        if entry is not None:
            for j in _STATES:
                out[j] = better(out[j], then(entry, matrix[i][j]))
    return out


def product(one: Matrix, other: Matrix) -> Matrix:
    return [row_times(row, other) for row in one]


def inserts() -> Matrix:
    """Cheapest insertions that lead from one state to another."""
    found: Matrix = [[(0, "") if i == j else None for j in _STATES] for i in _STATES]
    for _ in _STATES:
        for i in _STATES:
            for (m, role), j in _MOVES.items():
                if role in "ua":
                    found[i][j] = better(found[i][j], then(found[i][m], (INSERT, "I")))
    return found


def symbol_matrix(symbol: str) -> Matrix:
    """Insertions, then what may be done with one row."""
    edits: Matrix = [[None] * len(_STATES) for _ in _STATES]
    extra = TRUNCATED if symbol.isupper() else 0
    for i in _STATES:
        edits[i][i] = (DELETE, "D")
        for role, cost, letter in ((symbol.lower(), KEEP, "K"), ("u", REROLE, "R"), ("a", REROLE, "R")):
            j = _MOVES.get((i, role)) if symbol != "d" else None
            if j is not None:
                edits[i][j] = better(edits[i][j], (cost + extra, letter))
    return product(inserts(), edits)


def matrices(rules: list[str]) -> dict[str, Matrix]:
    """One matrix per symbol and per rule, each rule from its two parts."""
    found = {symbol: symbol_matrix(symbol) for symbol in _SYMBOLS}
    for k, (left, right) in enumerate(rules):
        found[chr(_FIRST_RULE + k)] = product(found[left], found[right])
    return found


class Repair:
    """The best edits of a sequence that comes in parts.

    What all open alternatives begin with is set aside after each part, so that ties compare
    only where they differ.
    """

    def __init__(self) -> None:
        self.agreed: list[str] = []
        self.open: list[Entry | None] = [(0, ""), None, None, None]

    def add(self, symbols: str, found: dict[str, Matrix]) -> None:
        for symbol in symbols:
            self.open = row_times(self.open, found[symbol])
        written = [None if e is None else (e[0], text_of(e[1])) for e in self.open]
        texts = [e[1] for e in written if e is not None]
        low, high = min(texts), max(texts)
        n = next((k for k, (a, b) in enumerate(zip(low, high)) if a != b), min(len(low), len(high)))
        self.agreed.append(low[:n])
        self.open = [None if e is None else (e[0], e[1][n:]) for e in written]

    def result(self) -> tuple[int, str]:
        ends, end = row_times(self.open, inserts()), None
        for state in _ACCEPTED:
            end = better(end, ends[state])
        return end[0], "".join(self.agreed) + text_of(end[1])


# The grammar ------------------------------------------------------------------------


def compress(sequences: list[str], rules: list[str]) -> list[str]:
    """Rules applied in their order, from the left and without overlap."""
    whole = "\n".join(sequences)
    for k, pair in enumerate(rules):
        whole = whole.replace(pair, chr(_FIRST_RULE + k))
    return whole.split("\n")


def _pair_counts(rules: list[str]):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[str] = Counter()
        symbols = 0
        for rows in batches:
            times = rows.column("n").to_pylist()
            for sequence, n in zip(compress(rows.column("seq").to_pylist(), rules), times):
                pairs = Counter(map("".join, zip(sequence, sequence[1:])))
                for pair in pairs:
                    if pair[0] == pair[1]:  # overlapping ones count once
                        pairs[pair] = sequence.count(pair)
                    found[pair] += n * pairs[pair]
                symbols += n * len(sequence)
        found[""] = symbols
        yield pa.RecordBatch.from_pydict(
            {"pair": pa.array(found, pa.string()), "n": pa.array(found.values(), pa.int64())}
        )

    return count


def choose_pairs(counts: list[tuple[str, int]], room: int) -> list[str]:
    """Frequent pairs that can't overlap: no symbol ends one and begins another."""
    firsts: set[str] = set()
    lasts: set[str] = set()
    chosen: list[str] = []
    for pair, n in counts:
        a, b = pair
        if n < 2 or len(chosen) == room:
            break
        alone = a != b or (a not in firsts and a not in lasts)
        if alone and a not in lasts and b not in firsts:
            chosen.append(pair)
            firsts.add(a)
            lasts.add(b)
    return chosen


def learn_grammar(sequences: DataFrame) -> list[str]:
    """Re-Pair over all sequences (seq, n): rules as pairs of symbols, in order.

    Each round counts the pairs of all compressed sequences and replaces the most frequent ones
    that don't overlap. At most (9 + ``MOST_RULES``) squared counts exist, whatever the input;
    the first ``MOST_RULES`` reach the driver.
    """
    rules: list[str] = []
    for _ in range(MOST_ROUNDS):
        counts = (
            sequences.mapInArrow(_pair_counts(rules), "pair string, n bigint")
            .groupBy("pair")
            .agg(F.sum("n").alias("n"))
        )
        first = counts.orderBy(F.length("pair"), F.desc("n"), "pair").limit(MOST_RULES + 1).collect()
        ordered = [(row.pair, row.n) for row in first]
        if len(ordered) < 2:
            break
        symbols = ordered[0][1]
        chosen = choose_pairs(ordered[1:], MOST_RULES - len(rules))
        saved = sum(dict(ordered)[pair] for pair in chosen)
        if not chosen or saved < LEAST_SAVED * symbols:
            break
        rules += chosen
    return rules


# Rows -------------------------------------------------------------------------------


def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text after damage by crc32 of ``conv_id:turn``; nulls of role and text
    are one space, as they are in that key. Dropped rows stay with null role and text."""
    blank = F.lit(" ")
    key = F.concat(
        F.coalesce(F.col("conv_id").cast("string"), blank),
        F.lit(":"),
        F.coalesce(F.col("turn").cast("string"), blank),
    )
    kind = F.crc32(key.cast("binary")) % 20
    text = F.coalesce(F.col("text").cast("string"), blank)
    text = (
        F.when(kind == 1, "")
        .when(kind == 2, F.translate(text, ".!?", ""))
        .otherwise(text)
    )
    role = F.when(kind == 4, USER).otherwise(F.coalesce(F.col("role").cast("string"), blank))
    copies = F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return conversations.select(
        "conv_id",
        "turn",
        F.when(kind != 0, role).alias("role"),
        F.when(kind != 0, text).alias("text"),
        F.explode(copies).alias("copy"),
    ).drop("copy")


def _identity() -> Column:
    """A digest of role and text; also the order of rows of one turn."""
    size = F.octet_length("role").cast("string")
    return F.unhex(F.sha2(F.concat(size, F.lit(":"), F.col("role"), F.col("text")).cast("binary"), 256))


def sequences_of(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """Blocks (conv_id, block, seq) of each conversation's symbols, with counts of its faults.

    ``rows`` have conv_id, turn, role and text (no nulls in the last two). One shuffle of keys
    by conversation serves both windows and the blocks.
    """
    last = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    keys = rows.select(
        "conv_id",
        "turn",
        F.substring("role", 1, 1).alias("initial"),
        _identity().alias("same"),
        (last == "").alias("blank"),
        (~last.isin(".", "!", "?")).alias("cut"),
    ).repartition("conv_id")
    earlier = Window.partitionBy("conv_id", "same").orderBy("turn")
    order = Window.partitionBy("conv_id").orderBy("turn", "same", "again")
    keys = keys.withColumn("again", F.row_number().over(earlier) > 1)
    keys = keys.select(
        "*",
        F.row_number().over(order).alias("n"),
        F.lag("initial").over(order).alias("before"),
        F.lag("turn").over(order).alias("turn_before"),
    )
    blank, again = F.col("blank"), F.col("again") & ~F.col("blank")
    cut = F.col("cut") & ~F.col("blank") & ~F.col("again")
    initial = F.col("initial")
    role = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    symbol = F.when(blank | again, "d").when(cut, F.upper(role)).otherwise(role)
    pair = F.concat("before", "initial")
    new_turn = F.col("turn").isNotNull() & ~F.col("turn").eqNullSafe(F.col("turn_before"))
    ordered = F.array_sort(F.collect_list(F.struct("n", symbol.alias("symbol"))))
    return keys.groupBy("conv_id", F.floor((F.col("n") - 1) / block).alias("block")).agg(
        F.array_join(F.transform(ordered, lambda x: x["symbol"]), "").alias("seq"),
        F.count_if(blank).alias("blank"),
        F.count_if(again).alias("duplicate"),
        F.count_if(cut).alias("truncated"),
        F.count_if(F.col("before").isNotNull() & ~pair.isin("su", "ua", "au")).alias("illegal"),
        F.min("turn").alias("low"),
        F.max("turn").alias("high"),
        F.count_if(new_turn).alias("turns"),
    )


_COUNTS = ("blank", "duplicate", "truncated", "illegal")
_FACTS = ("gaps", *_COUNTS, "cost")


def _fold(rules: list[str], found: dict[str, Matrix], names: list[str]):
    """Blocks in order to one row per conversation."""

    def row(conv, repair: Repair, sums: list, low, high, turns) -> dict:
        cost, audit = repair.result()
        gaps = 0 if low is None else high - low + 1 - turns
        return dict(zip(names, (conv, audit, gaps, *sums, cost)))

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, schema = None, None
        for rows in batches:
            out = []
            if schema is None:
                kinds = [rows.schema.field("conv_id").type, pa.string(), *[pa.int64()] * len(_FACTS)]
                schema = pa.schema(list(zip(names, kinds)))
            short = compress(rows.column("seq").to_pylist(), rules)
            for symbols, part in zip(short, rows.drop_columns(["seq"]).to_pylist()):
                if now is None or now[0] != part["conv_id"] or part["block"] == 0:
                    if now is not None:
                        out.append(row(*now))
                    now = [part["conv_id"], Repair(), [0] * len(_COUNTS), None, None, 0]
                now[1].add(symbols, found)
                now[2] = [a + part[name] for a, name in zip(now[2], _COUNTS)]
                now[3] = min((x for x in (now[3], part["low"]) if x is not None), default=None)
                now[4] = max((x for x in (now[4], part["high"]) if x is not None), default=None)
                now[5] += part["turns"]
            yield pa.RecordBatch.from_pylist(out, schema=schema)
        if now is not None:
            yield pa.RecordBatch.from_pylist([row(*now)], schema=schema)

    return fold


def repairs(blocks: DataFrame) -> DataFrame:
    """conv_id, audit and facts of each conversation from its blocks (``sequences_of``)."""
    ship(blocks.sparkSession)
    distinct = stage(blocks.groupBy("seq").agg(F.count(F.lit(1)).alias("n")), "sequences")
    rules = learn_grammar(distinct)
    names = ["conv_id", "audit", *_FACTS]
    kind = blocks.schema["conv_id"].dataType.simpleString()
    columns = ", ".join([f"conv_id {kind}, audit string", *(f"{name} bigint" for name in _FACTS)])
    ordered = blocks.repartition("conv_id").sortWithinPartitions("conv_id", "block")
    return ordered.mapInArrow(_fold(rules, matrices(rules), names), columns)


class _Hash:
    """The repaired hash of one conversation, row by row."""

    def __init__(self, audit: str) -> None:
        self.audit, self.at, self.first = audit, 0, True
        self.left = len(audit) - audit.count("D")
        self.sha = hashlib.sha256()

    def _put(self, role: str, text: str) -> None:
        self.sha.update(f"{'' if self.first else chr(10)}{role}:{text}".encode())
        self.first = False
        self.left -= 1

    def add_inserts(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            self._put(self._wanted(), "")
            self.at += 1

    def _wanted(self) -> str:
        return ASSISTANT if self.left % 2 else USER

    def add(self, role: str, text: str) -> None:
        self.add_inserts()
        letter = self.audit[self.at]
        self.at += 1
        if letter != "D":
            self._put(role if letter == "K" else self._wanted(), text)


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Head rows and texts, in order, to one result row per conversation."""
    now, sha, schema = None, None, None

    def row() -> dict:
        sha.add_inserts()
        return {**now, "repaired_sha256": sha.sha.hexdigest()}

    for rows in parts(batches, 500):
        out = []
        if schema is None:
            kinds = [rows.schema.field("conv_id").type, *[pa.int64()] * len(_FACTS), pa.string(), pa.string()]
            schema = pa.schema(list(zip(("conv_id", *_FACTS, "audit", "repaired_sha256"), kinds)))
        for part in rows.to_pylist():
            if now is None or now["conv_id"] != part["conv_id"]:
                if now is not None:
                    out.append(row())
                head = part["kind"] == 0
                now = {"conv_id": part["conv_id"], "audit": part["text"] if head else ""}
                now |= {name: part[name] if head else 0 for name in _FACTS}
                sha = _Hash(now["audit"])
            if part["kind"] == 2:
                sha.add(part["role"], part["text"])
        yield pa.RecordBatch.from_pylist(out, schema=schema)
    if now is not None:
        yield pa.RecordBatch.from_pylist([row()], schema=schema)


def repair(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per conversation: gaps, blank, duplicate, truncated, illegal, cost, audit and
    repaired_sha256.

    ``rows`` have conv_id, turn, role and text; other columns are ignored. A null role or text
    counts as one space. A row whose role and text are both null only names its conversation;
    one without any other row gets zeros, an empty audit and the hash of nothing. Rows go by
    turn, nulls first; rows of one turn by a digest of role and text, so equal rows are
    neighbours. A null conv_id is a conversation of its own. No row gives no row.
    """
    blank = F.lit(" ")
    named = rows.select("conv_id", "turn", "role", "text").withColumn(
        "kind", F.when(F.col("role").isNull() & F.col("text").isNull(), 1).otherwise(2)
    )
    named = named.withColumns(
        {"role": F.coalesce("role", blank), "text": F.coalesce("text", blank)}
    )
    blocks = stage(sequences_of(named.where("kind = 2"), block), "blocks")
    heads = stage(repairs(blocks), "repairs")
    none = F.lit(None)
    facts = [none.cast("bigint").alias(name) for name in _FACTS]
    turn = rows.schema["turn"].dataType
    texts = named.select("conv_id", "kind", "turn", _identity().alias("same"), "role", "text", *facts)
    heads = heads.select(
        "conv_id",
        F.lit(0).alias("kind"),
        none.cast(turn).alias("turn"),
        none.cast("binary").alias("same"),
        none.cast("string").alias("role"),
        F.col("audit").alias("text"),
        *_FACTS,
    )
    kind = rows.schema["conv_id"].dataType.simpleString()
    columns = ", ".join(
        [f"conv_id {kind}", *(f"{name} bigint" for name in _FACTS), "audit string, repaired_sha256 string"]
    )
    return (
        heads.unionByName(texts)
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "kind", "turn", "same")
        .select("conv_id", "kind", "role", "text", *_FACTS)
        .mapInArrow(_finish, columns)
    )


def _least(*entries: str) -> str:
    return f"list_min([{', '.join(entries)}])"


def _entry(state: int, cost: str, letter: str) -> str:
    return f"{{'c': acc.v[{state + 1}].c + {cost}, 'a': acc.v[{state + 1}].a || '{letter}'}}"


def _step(j: int) -> str:
    """The best way to state j over one row x, without insertions."""
    extra = f"CASE WHEN x.s BETWEEN 'A' AND 'Z' THEN {TRUNCATED} ELSE 0 END"
    ways = [_entry(j, str(DELETE), "D")]
    for (i, role), to in _MOVES.items():
        if to == j:
            stop = f"CASE WHEN lower(x.s) = '{role}' THEN 0 ELSE {_NEVER} END"
            ways.append(_entry(i, f"{extra} + {stop}", "K"))
            if role in "ua":
                stop = f"CASE WHEN x.s = 'd' THEN {_NEVER} ELSE {REROLE} END"
                ways.append(_entry(i, f"{extra} + {stop}", "R"))
    return _least(*ways)


def _inserted(j: int) -> str:
    """The best way to state j by at most one insertion."""
    ways = [_entry(i, str(INSERT), "I") for (i, role), to in _MOVES.items() if to == j and role in "ua"]
    return _least(f"acc.v[{j + 1}]", *ways)


#: A cost that no conversation of the checked tables reaches.
_NEVER = 10**12

SQL = f"""
WITH RECURSIVE raw AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key
    FROM conversations
), kinds AS (
    -- CRC-32 bit by bit: a byte is mixed in, then eight shifts.
    SELECT *, xor(list_reduce(
        flatten(list_transform(range(1, length(key) + 1), lambda i:
            [ascii(substr(key, i, 1))::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
        lambda c, t: CASE WHEN t >= 0 THEN xor(c, t)
            WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END,
        4294967295::BIGINT), 4294967295) % 20 AS kind
    FROM raw
), rows_ AS MATERIALIZED (
    SELECT conv_id, turn, CASE WHEN kind = 4 THEN '{USER}' ELSE role END AS role,
        CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
        unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
    FROM kinds WHERE kind > 0
), ordered AS MATERIALIZED (
    SELECT *, row_number() OVER turns AS n, lag(role[1]) OVER turns AS before,
        lag(turn) OVER turns AS turn_before,
        row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again,
        regexp_extract(text, '([^\\x20\\x09-\\x0D])[\\x20\\x09-\\x0D]*$', 1) AS last
    FROM rows_
    WINDOW turns AS (PARTITION BY conv_id
        ORDER BY turn NULLS FIRST, sha256(strlen(role) || ':' || role || text), copy)
), judged AS MATERIALIZED (
    SELECT *, last = '' AS blank, last != '' AND again AS dup,
        last != '' AND NOT again AND last NOT IN ('.', '!', '?') AS cut,
        CASE WHEN role[1] IN ('s', 'u', 'a') THEN role[1] ELSE 'o' END AS kind
    FROM ordered
), facts AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
        count(*) FILTER (blank) AS blank, count(*) FILTER (dup) AS duplicate,
        count(*) FILTER (cut) AS truncated,
        count(*) FILTER (n > 1 AND before || role[1] NOT IN ('su', 'ua', 'au')) AS illegal,
        flatten(list(CASE WHEN blank OR dup THEN ['d', '2', '3'] WHEN cut THEN [upper(kind), '2', '3']
            ELSE [kind, '2', '3'] END ORDER BY n)) AS tokens
    FROM judged GROUP BY conv_id
), solved AS (
    SELECT *, list_reduce(
        list_transform(tokens, lambda t: {{'s': t, 'v': []::STRUCT(c BIGINT, a VARCHAR)[]}}),
        lambda acc, x: {{'s': '', 'v': CASE x.s
            WHEN '2' THEN [acc.v[1], acc.v[2], {_inserted(2)}, acc.v[4]]
            WHEN '3' THEN [acc.v[1], acc.v[2], acc.v[3], {_inserted(3)}]
            ELSE [{_step(0)}, {_step(1)}, {_step(2)}, {_step(3)}] END}},
        {{'s': '', 'v': [{{'c': 0::BIGINT, 'a': ''}}, {{'c': {_NEVER}, 'a': ''}},
            {{'c': {INSERT}, 'a': 'I'}}, {{'c': {2 * INSERT}, 'a': 'II'}}]}}).v AS v
    FROM facts
), chosen AS MATERIALIZED (
    SELECT *, list_min([v[1], v[4]]) AS best FROM solved
), letters AS (
    SELECT conv_id, unnest(range(1, length(best.a) + 1)) AS p, best.a AS audit FROM chosen
), placed AS (
    SELECT conv_id, audit[p] AS letter, p,
        length(replace(audit[1:p], 'I', '')) AS n,
        length(replace(audit[p:], 'D', '')) AS left_
    FROM letters
), repaired AS (
    SELECT placed.conv_id, sha256(string_agg(
        CASE WHEN letter = 'K' THEN role WHEN left_ % 2 = 1 THEN '{ASSISTANT}' ELSE '{USER}' END
        || ':' || CASE WHEN letter = 'I' THEN '' ELSE text END, chr(10) ORDER BY p)) AS repaired_sha256
    FROM placed LEFT JOIN ordered
        ON ordered.conv_id IS NOT DISTINCT FROM placed.conv_id AND ordered.n = placed.n
    WHERE letter != 'D' GROUP BY placed.conv_id
)
SELECT known.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
    coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
    coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.c, 0)::BIGINT AS cost,
    coalesce(best.a, '') AS audit, coalesce(repaired_sha256, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) known
LEFT JOIN chosen ON chosen.conv_id IS NOT DISTINCT FROM known.conv_id
LEFT JOIN repaired ON repaired.conv_id IS NOT DISTINCT FROM known.conv_id
"""
