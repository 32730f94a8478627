"""Conversations as a prefix tree: turns that several conversations begin with are written once, depth first, with positions and attention intervals."""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyflow.llm.bytelevel import load_tokenizer, token_bytes
from tallyflow.llm.common import cut

#: Rows whose texts are worked on at once.
SLICE = 64


@dataclass(frozen=True)
class ChatTemplate:
    """A turn is opening, role, line feed, text, closing. A backslash goes before control strings and backslashes of a text, and a role's line feeds become backslash and n, so that both can be read back."""

    opening: str = "<turn>"
    closing: str = "</turn>"
    controls: tuple[str, ...] = ("<|endoftext|>",)
    #: Roles whose texts are under the loss mask.
    learned: tuple[str, ...] = ("assistant",)

    def pattern(self) -> str:
        """What is escaped, as Java and Python read it."""
        return "|".join(re.escape(x) for x in ("\\", self.opening, self.closing, *self.controls))

    def escaped(self, text):
        """Column: ``text`` with its control strings escaped."""
        return F.regexp_replace(text, self.pattern(), r"\\$0")

    def read(self, turn: str) -> tuple[str, str]:
        """(role, text) of a formatted turn."""
        end = turn.index("\n")
        body = turn[end + 1 : len(turn) - len(self.closing)]
        if not turn.startswith(self.opening) or turn[len(turn) - len(self.closing) :] != self.closing or re.search(self.pattern(), re.sub(r"\\.", "", body, flags=re.S)):
            raise ValueError("not a formatted turn")
        return plain(turn[len(self.opening) : end], "\n"), plain(body)


def plain(text: str, n: str = "n") -> str:
    """``text`` without escapes; ``n``: what an escaped n stands for."""
    return re.sub(r"\\(.)", lambda m: n if m[1] == "n" else m[1], text, flags=re.S)


class Chat(NamedTuple):
    """turns: (segment, turn, role, start, position, n_tokens, loss_from, loss_to, ids), a row for each shared or own turn, once.
    segments: (segment, tree, start, n_tokens, position, ancestors). members: (conv_id, segment), a row for each conversation."""

    turns: DataFrame
    segments: DataFrame
    members: DataFrame


def _chain(batches):
    """(segment, turn, prefix): a digest of the first turns of each key, 16 bytes a turn."""
    import pyarrow as pa

    for batch in batches:
        for segment, key in zip(batch.column("segment").to_pylist(), batch.column("key").to_pylist(), strict=True):
            out, now = [], b""
            for i in range(0, len(key), 16):
                now = hashlib.blake2b(now + key[i : i + 16], digest_size=16).digest()
                out.append(now)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(out), segment)), pa.array(np.arange(1, len(out) + 1, dtype=np.int32)), pa.array(out, pa.binary())], ["segment", "turn", "prefix"])


def _coded(path: str, template: ChatTemplate):
    def run(batches):
        import pyarrow as pa

        tokenizer = load_tokenizer(path)
        heads: dict[str, list[int]] = {}
        tail = tokenizer.encode(template.closing, add_special_tokens=False).ids
        learned = set(template.learned)
        for batch in batches:
            for low in range(0, batch.num_rows, SLICE):
                part = batch.slice(low, SLICE)
                roles, written = part.column("role").to_pylist(), part.column("written").to_pylist()
                bodies = [x.ids for x in tokenizer.encode_batch(part.column("text").to_pylist(), add_special_tokens=False)]
                ids, loss = [], []
                for role, shown, body in zip(roles, written, bodies, strict=True):
                    if shown not in heads:
                        if len(heads) > 10_000:
                            heads.clear()
                        heads[shown] = tokenizer.encode(f"{template.opening}{shown}\n", add_special_tokens=False).ids
                    head = heads[shown]
                    ids.append(head + body + tail)
                    loss.append((len(head), len(head) + len(body)) if role in learned else (0, 0))
                columns = {"segment": part.column("segment"), "turn": part.column("turn"), "role": part.column("role"), "n_tokens": pa.array([len(x) for x in ids], pa.int64())}
                columns |= {c: pa.array([x[i] for x in loss], pa.int64()) for i, c in enumerate(("loss_from", "loss_to"))}
                yield pa.RecordBatch.from_pydict(columns | {"ids": pa.array(ids, pa.list_(pa.int32()))})

    return run


def format_conversations(turns: DataFrame, tokenizer: str, template: ChatTemplate = ChatTemplate()) -> Chat:
    """Rows of ``turns`` (conv_id, turn, role, text; other columns are ignored) as a forest of prefixes, tokenized with the byte-level vocabulary of the file ``tokenizer``.

    1. Each conversation gets a key of 16 bytes a turn, digests of role and text; keys sort as the tree's turns do, depth first.
       Equal conversations are one. A range sort numbers them (``segment``), in any number of tasks.
    2. A prefix belongs to the first segment that holds it, found by digests of prefixes, counted before they are shuffled. A
       segment writes the turns that no earlier one has; the others are its ancestors, in stretches of earlier segments.
    3. Roles' heads, texts and closings are tokenized apart, so that the loss mask (loss_from to loss_to within the turn's ids) is
       the text of learned roles exactly. ``start`` is a turn's first place in the depth-first output, gapless from 0; ``tree`` is the
       start of its tree. Positions go on along the path: a token's is position plus its place in the turn.
    4. A token of a segment attends to ``ancestors`` (start, end, and the turns first to last of the segment that wrote them) and
       to what is before it in its own segment, and to nothing else of the tree.

    Turns of a conversation go by turn (null first), equal ones by digest; rows that repeat stay. Null roles and texts are empty. Rows without conv_id are one
    conversation. A conversation's key must fit a row: 16 bytes a turn. An empty table gives empty tables.
    """
    own = Window.partitionBy("c", "no_c").orderBy("turn", "digest")
    rows = turns.select(F.coalesce(F.col("conv_id").cast("long"), F.lit(0)).alias("c"), F.col("conv_id").isNull().alias("no_c"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    told = F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    rows = rows.withColumn("digest", F.substring(F.sha2(told, 256), 1, 32))
    keys = rows.groupBy("c", "no_c").agg(F.unhex(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("turn", "digest"))), lambda x: x["digest"]), "")).alias("key"))
    keys = cut(keys)
    firsts = keys.groupBy("key").agg(F.min(F.struct("no_c", "c")).alias("f"))
    segments = cut(firsts.select("key", "f.c", "f.no_c").orderBy("key").withColumn("segment", F.monotonically_increasing_id()))

    prefixes = segments.select("segment", "key").mapInArrow(_chain, "segment long, turn int, prefix binary")
    shared = prefixes.groupBy("prefix").agg(F.min("segment").alias("owner"), F.count("*").alias("n")).where("n > 1")
    runs = cut(prefixes.join(shared, "prefix").where("owner < segment").groupBy("segment", "owner").agg(F.max("turn").alias("last")))
    taken = segments.select("segment", "c", "no_c").join(runs.groupBy("segment").agg(F.max("last").alias("taken")), "segment", "left").select("segment", "c", "no_c", F.coalesce("taken", F.lit(0)).alias("taken"))
    taken = cut(taken)

    written = rows.join(taken, ["c", "no_c"]).withColumn("turn", F.row_number().over(own)).where("turn > taken")
    shown = F.regexp_replace(template.escaped(F.col("role")), "\n", r"\\n")
    coded = cut(written.select("segment", "turn", "role", shown.alias("written"), template.escaped(F.col("text")).alias("text")).mapInArrow(_coded(tokenizer, template), "segment long, turn int, role string, n_tokens long, loss_from long, loss_to long, ids array<int>"))

    before = Window.partitionBy("segment").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    within = cut(coded.select("segment", "turn", "n_tokens", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("within")))
    sizes = within.groupBy("segment").agg(F.sum("n_tokens").alias("n_tokens")).withColumn("span", F.shiftright("segment", 33))
    spans = Window.orderBy("span").rowsBetween(Window.unboundedPreceding, -1)  # a row for each task of the range sort
    ahead = sizes.groupBy("span").agg(F.sum("n_tokens").alias("n")).select("span", F.coalesce(F.sum("n").over(spans), F.lit(0)).alias("ahead"))
    inside = Window.partitionBy("span").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    starts = cut(sizes.join(F.broadcast(ahead), "span").select("segment", "n_tokens", (F.col("ahead") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).alias("start")))

    reach = within.select(F.col("segment").alias("owner"), F.col("turn").alias("last"), (F.col("within") + F.col("n_tokens")).alias("reach"))
    owners = starts.join(taken, "segment").select(F.col("segment").alias("owner"), "start", (F.col("taken") + 1).alias("first"))
    stretches = runs.join(reach, ["owner", "last"]).join(owners, "owner")
    interval = F.struct("start", (F.col("start") + F.col("reach")).alias("end"), F.col("owner").alias("segment"), "first", "last")
    paths = stretches.groupBy("segment").agg(F.sort_array(F.collect_list(interval)).alias("ancestors"), F.sum("reach").alias("position"))
    none = F.array().cast("array<struct<start:bigint,end:bigint,segment:bigint,first:int,last:int>>")
    placed = starts.join(paths, "segment", "left").select("segment", F.coalesce(F.get("ancestors", F.lit(0))["start"], "start").alias("tree"), "start", "n_tokens", F.coalesce("position", F.lit(0)).cast("long").alias("position"), F.coalesce("ancestors", none).alias("ancestors"))
    placed = cut(placed)
    bases = placed.select("segment", F.col("start").alias("s"), F.col("position").alias("p"))
    out = coded.join(within.select("segment", "turn", "within"), ["segment", "turn"]).join(bases, "segment")
    out = out.select("segment", "turn", "role", (F.col("s") + F.col("within")).alias("start"), (F.col("p") + F.col("within")).alias("position"), "n_tokens", "loss_from", "loss_to", "ids")
    members = keys.join(segments.select("key", "segment"), "key").select(F.when(~F.col("no_c"), F.col("c")).alias("conv_id"), "segment")
    return Chat(out, placed, members)


def _read(path: str, template: ChatTemplate):
    """From (segment, turn, ids, loss_from, loss_to) in order of segment and turn, wherever batches end: figures of each segment's conversation, read from its tokens."""

    def run(batches):
        import pyarrow as pa

        table = token_bytes(path)
        text_of = lambda ids: b"".join(map(table.__getitem__, ids)).decode()
        now, state = None, None

        def done():
            return now, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]

        for batch in batches:
            found = []
            for low in range(0, batch.num_rows, SLICE):
                part = batch.slice(low, SLICE)
                columns = [part.column(c).to_pylist() for c in ("segment", "ids", "loss_from", "loss_to")]
                for segment, ids, loss_from, loss_to in zip(*columns, strict=True):
                    if segment != now:
                        if now is not None:
                            found.append(done())
                        now, state = segment, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                    formatted = text_of(ids)
                    role, text = template.read(formatted)
                    learned = plain(text_of(ids[loss_from:loss_to]))
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode())
                    state[2] += len(learned)
                    state[3].update(learned.encode())
                    state[4] += len(formatted)
            yield _figures(found)
        if now is not None:
            yield _figures([done()])

    def _figures(found):
        kinds = {"segment": pa_int(), "n_turns": pa_int(), "turns_sha256": None, "loss_chars": pa_int(), "loss_sha256": None, "formatted_chars": pa_int()}
        import pyarrow as pa

        return pa.RecordBatch.from_pydict({c: pa.array([x[i] for x in found], kind or pa.string()) for i, (c, kind) in enumerate(kinds.items())})

    def pa_int():
        import pyarrow as pa

        return pa.int64()

    return run


def read_conversations(chat: Chat, tokenizer: str, template: ChatTemplate = ChatTemplate()) -> DataFrame:
    """Per conversation, read back from tokens along its path (ancestors, then its own segment): conv_id, n_turns, turns_sha256 (role, line feed, text, line feed for each turn), loss_chars and loss_sha256 (code points and digest of what the loss mask covers, unescaped) and formatted_chars.

    Equal conversations are read once. A conversation's turns meet in one task in order, but one at a time; a wanted shared turn
    is joined once for each conversation that holds it.
    """
    pieces = chat.turns.select(F.col("segment").alias("owner"), "turn", "ids", "loss_from", "loss_to")
    past = chat.segments.select("segment", F.explode("ancestors").alias("a")).select("segment", F.col("a.segment").alias("owner"), F.explode(F.sequence("a.first", "a.last")).alias("turn"))
    ahead = past.join(pieces, ["owner", "turn"]).select("segment", "turn", "ids", "loss_from", "loss_to")
    whole = ahead.unionByName(pieces.withColumnRenamed("owner", "segment"))
    figures = whole.repartition("segment").sortWithinPartitions("segment", "turn").mapInArrow(_read(tokenizer, template), "segment long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
    return chat.members.join(figures, "segment").select("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
