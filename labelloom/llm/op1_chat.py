"""Chat formatting: the lines of a transcript are a hidden Markov chain of roles, recovered by Viterbi and rendered as canonical turns.

Each line shows one speaker marker (such as ``User:``, ``### Assistant``, ``[system]``, or none) and a few features (length, question, list, code). How
often a role shows each feature is counted over all rows whose role is known; how roles follow one another is counted over turns
of the same conversation. Both are sums that Spark combines on the map side; only the small tables of counts reach the driver. Within a row a line without
marker mostly goes on with the role of the line before. The row's own role, if it is a known one, counts as a marker of its first line.

A row is one cell of text, of any length; each is parsed whole and by itself, so no conversation has to fit into one task, however long. Null or empty text: one
empty turn of the row's role, if known, else no turn. Unknown or null roles: decided by the chain. Repeated rows get equal results.
"""
from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from labelloom.llm.common import annotate, arrow, column

ROLES = ("assistant", "system", "tool", "user")
#: The words that transcripts use for each role.
SPEAKERS = {"user": "user", "human": "user", "q": "user", "question": "user", "customer": "user", "me": "user", "prompter": "user",
            "assistant": "assistant", "ai": "assistant", "a": "assistant", "answer": "assistant", "bot": "assistant", "model": "assistant", "gpt": "assistant", "agent": "assistant",
            "system": "system", "instruction": "system", "instructions": "system", "context": "system",
            "tool": "tool", "function": "tool", "observation": "tool", "result": "tool"}
MARKER = re.compile(r"^[ \t]*(?:#{1,6}[ \t]*|[*_]{1,2}|\[|<\|?(?:im_start\|>)?|>[ \t]*)?(" + "|".join(sorted(SPEAKERS, key=len, reverse=True)) + r")(?:[*_]{1,2}:?|:[*_]{0,2}|\]:?|\|?>:?|[ \t]*:)[ \t]*", re.I)
HEADING = re.compile(r"^[ \t]*#{1,6}[ \t]*(" + "|".join(sorted(SPEAKERS, key=len, reverse=True)) + r")[ \t]*:?[ \t]*$", re.I)
END = re.compile(r"<\|(?:im_end|end|eot_id)\|>")
#: A marker names its role rightly in so many of 1000 cases; a line without marker changes the speaker in so many.
TRUST, TURN = 990, 20
FEATURES = ("length", "shape", "end")


def known(role: str | None) -> str | None:
    return SPEAKERS.get((role or "").strip().lower())


def lines(text: str) -> list[tuple[str | None, str]]:
    """(role of the marker or None, rest of the line)."""
    out = []
    for line in END.sub("", text).split("\n"):
        m = MARKER.match(line) or HEADING.match(line)
        out.append((SPEAKERS[m[1].lower()], line[m.end():]) if m else (None, line))
    return out


def features(line: str) -> tuple[str, ...]:
    stripped = line.strip()
    size = len(stripped)
    length = "none" if not size else "short" if size < 40 else "middle" if size < 160 else "long"
    shape = "code" if line[:4] == "    " or stripped.startswith(("```", "def ", "import ", "{", "$ ")) else "list" if re.match(r"[-*•]\s|\d+[.)]\s", stripped) else "plain"
    end = "question" if stripped[-1:] in ("?", "¿") else "colon" if stripped[-1:] == ":" else "other"
    return length, shape, end


class Chain:
    """Log probabilities: ``shows[feature][value][role]``, ``follows[role][role]``, ``first[role]``."""

    def __init__(self, shown: dict[tuple[str, str, str], int], moves: dict[tuple[str, str], int]):
        values = {f: sorted({v for ff, v, _ in shown if ff == f}) for f in FEATURES}
        self.shows = {}
        for f in FEATURES:
            total = np.array([sum(shown.get((f, v, r), 0) for v in values[f]) for r in ROLES]) + len(values[f]) + 1
            for v in values[f]:
                self.shows[f, v] = np.log((np.array([shown.get((f, v, r), 0) for r in ROLES]) + 1) / total)
        turns = np.array([[moves.get((a, b), 0) for b in ROLES] for a in ROLES], float) + 1
        np.fill_diagonal(turns, 0)
        turns /= turns.sum(1, keepdims=True)
        self.stay = np.log(np.where(np.eye(len(ROLES)) > 0, 1 - TURN / 1000, turns * TURN / 1000))
        self.change = np.log(turns * 0.9 + 0.1 / len(ROLES))
        first = np.array([sum(moves.get((a, b), 0) for b in ROLES) for a in ROLES], float) + 1
        self.first = np.log(first / first.sum())

    def roles(self, some: list[tuple[str | None, str]], own: str | None) -> list[str]:
        """The likeliest role of each line (Viterbi). Equal likelihoods: the role that comes first in the alphabet."""
        if not some:
            return []
        back = np.zeros((len(some), len(ROLES)), np.int8)
        best = None
        for i, (mark, line) in enumerate(some):
            seen = np.zeros(len(ROLES))
            for f, v in zip(FEATURES, features(line)):
                seen = seen + self.shows.get((f, v), 0)
            mark = mark or (own if i == 0 else None)
            if mark:
                seen = seen + np.log(np.where(np.array(ROLES) == mark, TRUST / 1000, (1000 - TRUST) / 1000 / (len(ROLES) - 1)))
            if best is None:
                best = self.first + seen
            else:
                step = best[:, None] + (self.change if mark else self.stay)
                back[i] = step.argmax(0)
                best = step.max(0) + seen
        at, out = int(best.argmax()), []
        for i in range(len(some) - 1, -1, -1):
            out.append(ROLES[at])
            at = int(back[i][at])
        return out[::-1]

    def turns(self, text: str | None, role: str | None) -> list[tuple[str, str]]:
        """(role, text) of each turn. A marker begins a turn, and so does a change of role."""
        own = known(role)
        if not text:
            return [(own, "")] if own else []
        some = lines(text)
        out: list[tuple[str, list[str]]] = []
        for (mark, line), r in zip(some, self.roles(some, own)):
            if not out or mark or out[-1][0] != r:
                out.append((r, []))
            out[-1][1].append(line)
        return [(r, "\n".join(x).strip()) for r, x in out]


def rendered(turns: list[tuple[str, str]]) -> str:
    return "".join(f"<|{r}|>\n{x}\n<|end|>\n" for r, x in turns)


def train(rows: DataFrame) -> Chain:
    """Counts over all rows of (conv_id, turn, role, text) with a known role."""
    def shown(batches):
        for batch in batches:
            count: dict[tuple[str, str, str], int] = {}
            for role, text in zip(column(batch, "role").to_pylist(), column(batch, "text").to_pylist()):
                own = known(role)
                if own and text:
                    for mark, line in lines(text):
                        for f, v in zip(FEATURES, features(line)):
                            if mark in (None, own):
                                count[f, v, own] = count.get((f, v, own), 0) + 1
            yield pa.RecordBatch.from_pylist([{"f": f, "v": v, "r": r, "n": n} for (f, v, r), n in count.items()], pa.schema([("f", pa.string()), ("v", pa.string()), ("r", pa.string()), ("n", pa.int64())]))

    counts = arrow(rows.select("role", "text"), shown, "f string, v string, r string, n long").groupBy("f", "v", "r").agg(F.sum("n").alias("n")).collect()
    mapping = F.create_map(*[F.lit(x) for kv in SPEAKERS.items() for x in kv])
    turns = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), F.element_at(mapping, F.lower(F.trim("role"))).alias("r")).filter("r is not null and turn is not null and conv_id is not null").distinct()
    after = turns.select(F.col("conv_id").alias("c"), (F.col("turn") - 1).alias("t"), F.col("r").alias("next"))
    moves = turns.join(after, (F.col("conv_id") == F.col("c")) & (F.col("turn") == F.col("t"))).groupBy("r", "next").agg(F.count("*").alias("n")).collect()
    return Chain({(x["f"], x["v"], x["r"]): x["n"] for x in counts}, {(x["r"], x["next"]): x["n"] for x in moves})


def format_turns(rows: DataFrame, chain: Chain) -> DataFrame:
    """Narrow: appends n_turns, roles (comma-joined), rendered and its SHA-256."""
    shared = rows.sparkSession.sparkContext.broadcast(chain)

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        found = [shared.value.turns(t, r) for t, r in zip(column(batch, "text").to_pylist(), column(batch, "role").to_pylist())]
        out = [rendered(x) for x in found]
        return [pa.array([len(x) for x in found], pa.int64()), pa.array([",".join(r for r, _ in x) for x in found], pa.string()), pa.array(out, pa.string()),
                pa.array([hashlib.sha256(x.encode()).hexdigest() for x in out], pa.string())]

    return annotate(rows, run, [T.StructField("n_turns", T.LongType()), T.StructField("roles", T.StringType()), T.StructField("rendered", T.StringType()), T.StructField("rendered_sha256", T.StringType())])
