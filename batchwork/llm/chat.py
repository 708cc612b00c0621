"""Chat formatting at token level.

Each segment of a turn (template text, role name, content) is encoded on its own with an
ordinary encoder, and control marks are spliced in as reserved ids beyond the vocabulary,
so no content can ever produce a control id.  Loss masks come from prefix sums over the
segment lengths.  Control strings that occur in content are also escaped in the text, by a
backslash after their first character (one more where there are some already), so that the
formatted string can be read back as well.

Turns are encoded where they lie; only then are conversations brought together and given
running token offsets by a task that streams over its sorted rows, so that neither needs
memory for a whole conversation.  Hashing a conversation in order is sequential by nature.

Defined results: null text and null role are empty; a role other than system, user and
assistant is kept by name; turns with the same number are ordered by role, then text; a null
turn number comes first; null conversation ids form one conversation; repeated rows are
repeated turns; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CONTROLS = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[/ROLE]"]
BOS, EOS, INST, INST_END, SYS, SYS_END, ROLE, ROLE_END = range(len(CONTROLS))
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# the published split pattern of this vocabulary (fixed value)
SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# the first character of a control string and the backslashes before the rest of it
_MARK = re.compile("|".join(rf"{re.escape(c[0])}\\*(?={re.escape(c[1:])})" for c in CONTROLS))


def escape(text: str) -> str:
    return _MARK.sub(lambda m: m[0] + "\\", text)


def unescape(text: str) -> str:
    return _MARK.sub(lambda m: m[0].removesuffix("\\"), text)


def read_vocabulary(path: str = TOKENIZER) -> bytes:
    """The vocabulary file; read on the driver and sent to the tasks (about 1 MB)."""
    with open(path, "rb") as f:
        return f.read()


def encoding(vocabulary: bytes):
    """The encoder and the first reserved id."""
    import tiktoken
    ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in vocabulary.splitlines() if line)}
    return tiktoken.Encoding("chat", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={}), max(ranks.values()) + 2


def turn_segments(role: str, text: str) -> list[tuple[int | str, bool]]:
    """A turn as segments: a control (its number) or a text, with its loss flag."""
    body = escape(text)
    if role == "user":
        return [(INST, False), (" ", False), (body, False), (" ", False), (INST_END, False)]
    if role == "system":
        return [(SYS, False), ("\n", False), (body, False), ("\n", False), (SYS_END, False)]
    if role == "assistant":
        return [(" ", False), (body, True), (EOS, False)]
    return [(ROLE, False), (escape(role), False), (ROLE_END, False), (body, False), (EOS, False)]


def assemble(segments: list[tuple[int | str, bool]], encode, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Token ids and loss mask of the segments."""
    ids = [[base + s] if isinstance(s, int) else encode(s) for s, _ in segments]
    ends = np.cumsum([len(x) for x in ids])
    step = np.zeros(ends[-1] + 1, np.int8)
    for (_, loss), part, end in zip(segments, ids, ends):
        if loss:
            step[end - len(part)] += 1
            step[end] -= 1
    return np.fromiter((t for part in ids for t in part), np.int32, ends[-1]), np.cumsum(step[:-1]).astype(bool)


FORMATTED = "conv_id {id}, seq long, token_offset long, ids array<int>, loss_mask array<boolean>"


def format_chat(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                text_col: str = "text", tokenizer: str = TOKENIZER) -> DataFrame:
    """One row per turn: conversation, place in it, offset of its first token, ids, loss mask."""
    vocabulary = rows.sparkSession.sparkContext.broadcast(read_vocabulary(tokenizer))
    id_type = dict(rows.dtypes)[conv_col]
    turn_type = dict(rows.dtypes)[turn_col]

    def encode_turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, base = encoding(vocabulary.value)
        for b in batches:
            ids, masks = [], []
            for role, text in zip(b.column("role").to_pylist(), b.column("text").to_pylist()):
                i, m = assemble(turn_segments(role, text), enc.encode_ordinary, base)
                ids.append(i)
                masks.append(m)
            yield pa.RecordBatch.from_arrays([b.column("conv_id"), b.column("turn"), b.column("role"), b.column("text"), pa.array(ids, pa.list_(pa.int32())),
                                              pa.array(masks, pa.list_(pa.bool_()))], names=["conv_id", "turn", "role", "text", "ids", "loss_mask"])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, base = encoding(vocabulary.value)
        now, seq, offset = object(), 0, 0
        for b in batches:
            convs, ids, masks = b.column("conv_id").to_pylist(), b.column("ids").to_pylist(), b.column("loss_mask").to_pylist()
            seqs, offsets = [], []
            for k, c in enumerate(convs):
                if c != now:
                    now, seq, offset = c, 0, 0
                    ids[k], masks[k] = [base + BOS, *ids[k]], [False, *masks[k]]
                seqs.append(seq)
                offsets.append(offset)
                seq, offset = seq + 1, offset + len(ids[k])
            yield pa.RecordBatch.from_arrays([b.column("conv_id"), pa.array(seqs, pa.int64()), pa.array(offsets, pa.int64()),
                                              pa.array(ids, pa.list_(pa.int32())), pa.array(masks, pa.list_(pa.bool_()))],
                                             names=["conv_id", "seq", "token_offset", "ids", "loss_mask"])

    turns = rows.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    encoded = turns.mapInArrow(encode_turns, f"conv_id {id_type}, turn {turn_type}, role string, text string, ids array<int>, loss_mask array<boolean>")
    return (encoded.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
            .select("conv_id", "ids", "loss_mask").mapInArrow(place, FORMATTED.format(id=id_type)))


def read_tokens(ids, mask, decode, base: int) -> tuple[str, str, int, str]:
    """Role, text, formatted length and text under the mask (unescaped) of one formatted turn."""
    parts, chars, run = [], 0, []
    for t in [*ids, None]:
        if t is not None and t < base:
            run.append(t)
            continue
        if run:
            parts.append(decode(run))
            chars += len(parts[-1])
            run = []
        if t is not None:
            parts.append(t - base)
            chars += len(CONTROLS[t - base])
    if parts[:1] == [BOS]:
        parts = parts[1:]
    texts = [p for p in parts if isinstance(p, str)]
    under = unescape(decode([t for t, m in zip(ids, mask) if m]))
    if parts[0] == INST:
        return "user", unescape("".join(texts)[1:-1]), chars, under
    if parts[0] == SYS:
        return "system", unescape("".join(texts)[1:-1]), chars, under
    if parts[0] == ROLE:
        end = parts.index(ROLE_END)
        role, text = ("".join(p for p in side if isinstance(p, str)) for side in (parts[:end], parts[end:]))
        return unescape(role), unescape(text), chars, under
    return "assistant", unescape("".join(texts)[1:]), chars, under


def read_back(formatted: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """One row per conversation, from its formatted turns alone."""
    vocabulary = formatted.sparkSession.sparkContext.broadcast(read_vocabulary(tokenizer))
    id_type = dict(formatted.dtypes)["conv_id"]

    def decode_turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, base = encoding(vocabulary.value)

        def decode(ids: list[int]) -> str:
            return enc.decode_bytes(ids).decode("utf-8")
        for b in batches:
            out = [read_tokens(i, m, decode, base) for i, m in zip(b.column("ids").to_pylist(), b.column("loss_mask").to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column("conv_id"), b.column("seq"), *(pa.array([o[k] for o in out], pa.int64() if k == 2 else pa.string()) for k in range(4))],
                                             names=["conv_id", "seq", "role", "text", "chars", "loss_text"])

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        conv_type, now, turns, done = None, object(), None, []

        def close():
            if turns is not None:
                done.append((now, turns[0], turns[1].hexdigest(), turns[2], turns[3].hexdigest(), turns[4]))

        def batch():
            types = [conv_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], t) for k, t in enumerate(types)], names=names)
        for b in batches:
            conv_type = b.column("conv_id").type
            for c, role, text, chars, loss in zip(*(b.column(n).to_pylist() for n in ("conv_id", "role", "text", "chars", "loss_text"))):
                if turns is None or c != now:
                    close()
                    now, turns = c, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                turns[0] += 1
                turns[1].update(f"{role}\n{text}\n".encode())
                turns[2] += len(loss)
                turns[3].update(loss.encode())
                turns[4] += chars
            if len(done) > 5000:
                yield batch()
                done.clear()
        close()
        if done:
            yield batch()

    decoded = formatted.select("conv_id", "seq", "ids", "loss_mask").mapInArrow(decode_turns, f"conv_id {id_type}, seq long, role string, text string, chars long, loss_text string")
    return (decoded.repartition("conv_id").sortWithinPartitions("conv_id", "seq").mapInArrow(
        fold, f"conv_id {id_type}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"))
