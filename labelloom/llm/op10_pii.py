"""Personal data by anchor expansion: an Aho-Corasick automaton finds at-signs, plus signs, digits, schemes and identifier cues in one
pass over the text; local parsers then walk from the anchor to the left and right, and check what they found.

Base kinds, as fixed by contract: email, ip, card, phone; each kind's matches are the leftmost ones that do not overlap, and a match that
fails its check is dropped together with its characters. The method adds: url (user:password before the host), iban (country, check
digits, remainder 1 of 97) and account: behind a cue such as "passport:", a word with a digit, and where it has fewer than 6 letters and digits the groups of two or
more digits that follow it after single spaces; 6 to 34 letters and digits in all, three digits at least. Nothing may stick to the cue or the number. Cues that are also
verbs ("compte", "cuenta", "account") need a mark (":", "#", "no." and the like) before the number.

Null and empty text: no spans. Texts of any length are read whole in linear time. Repeated rows get equal results; other columns pass.
"""
from __future__ import annotations

import functools
import hashlib
import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from labelloom.llm.common import annotate, texts

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "url", "iban", "account")
#: Cues before an account or identity number, and schemes whose authority may hold a user and a password.
CUES = ("account", "acct", "iban", "konto", "kontonummer", "cuenta", "compte", "ssn", "social security", "passport", "passeport", "pasaporte",
        "reisepass", "tax id", "steuer-id", "driver license", "customer id", "kundennummer")
SCHEMES = ("http://", "https://", "ftp://", "ssh://", "postgres://", "mysql://", "redis://", "amqp://")

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
QUAD = re.compile(r"[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
CHAIN = re.compile(r"[0-9](?:[ -]?[0-9])++")
PLUS = re.compile(r"\+[0-9][ ().0-9-]++")
AUTHORITY = re.compile(r"[A-Za-z0-9._~%!$&'()*+,;=-]+:[^\s/@]*@[A-Za-z0-9.-]+(?::[0-9]+)?")
IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}")
#: Cues that are also verbs.
VERBS = frozenset(("account", "cuenta", "compte"))
LEAD = re.compile(r"[ ]?((?:number|no|nr|num|code|id)\b\.?)?[ ]?(is |:|=|#)?[ ]?(#)?", re.I)
TOKEN = re.compile(r"[A-Za-z0-9](?:[A-Za-z0-9-]{0,64}[A-Za-z0-9])?")
GROUP = re.compile(r" [0-9]{2,}(?![A-Za-z0-9])")


@functools.lru_cache(1)
def automaton() -> ahocorasick.Automaton:
    """Anchors and what they announce. Digits announce ip and card, so that numbers need no second pass."""
    out = ahocorasick.Automaton()
    for mark in ("@", "+", *"0123456789"):
        out.add_word(mark, (mark if mark in "@+" else "0", 1))
    for kind, words in (("url", SCHEMES), ("cue", CUES)):
        for w in words:
            for form in {w, w.upper(), w.capitalize(), w.title()}:
                out.add_word(form, (kind, len(form)))
    out.make_automaton()
    return out


def luhn(digits: str) -> bool:
    total = sum(int(x) for x in digits[-1::-2]) + sum(sum(divmod(2 * int(x), 10)) for x in digits[-2::-2])
    return total % 10 == 0


def iban_holds(raw: str) -> bool:
    moved = raw[4:] + raw[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """All spans (start, end) by kind, in order."""
    out: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    done = dict.fromkeys((*KINDS, "0"), 0)  # up to where each kind has read
    for last, (kind, length) in automaton().iter(text):
        at = last - length + 1
        if kind == "0":
            if at < done["0"]:
                continue
            run = CHAIN.match(text, at)
            done["0"] = run.end() if run else at + 1
            if run:
                digits = re.sub(r"[^0-9]", "", run[0])
                if 13 <= len(digits) <= 19 and luhn(digits):
                    out["card"].append(run.span())
            place = max(at, done["ip"])
            while place < done["0"]:  # numbers of the run; joined by points they may go on behind it
                if not "0" <= text[place] <= "9":
                    place += 1
                    continue
                quad = QUAD.match(text, place)
                if quad:
                    if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in quad[0].split(".")):
                        out["ip"].append(quad.span())
                    place = done["ip"] = quad.end()
                else:
                    while place < done["0"] and "0" <= text[place] <= "9":
                        place += 1
        elif kind == "@":
            begin = at
            while begin > done["email"] and text[begin - 1] in LOCAL:
                begin -= 1
            if begin < at and (host := DOMAIN.match(text, at + 1)):
                out["email"].append((begin, host.end()))
                done["email"] = host.end()
        elif kind == "+":
            if at >= done["phone"] and (run := PLUS.match(text, at)):
                end = run.end()
                while not "0" <= text[end - 1] <= "9":
                    end -= 1
                if end >= at + 4:
                    done["phone"] = end
                    if 9 <= sum("0" <= c <= "9" for c in text[at:end]) <= 15:
                        out["phone"].append((at, end))
        elif kind == "url":
            if at >= done["url"] and (run := AUTHORITY.match(text, last + 1)):
                out["url"].append((at, run.end()))
                done["url"] = run.end()
        elif at >= done["account"] and not text[at - 1:at].isalnum() and not text[last + 1:last + 2].isalnum():
            lead = re.compile(r"[ ]?[:=#]?[ ]?").match(text, last + 1).end()
            if (run := IBAN.match(text, lead)) and (cut := longest_iban(run[0])):
                out["iban"].append((lead, lead + cut))
                done["account"] = lead + cut
            elif run := account(text, last + 1, text[at:last + 1].lower() in VERBS):
                out["account"].append(run)
                done["account"] = run[1]
    return out


def account(text: str, place: int, marked: bool) -> tuple[int, int] | None:
    """(start, end) of the number behind a cue that ends at ``place``; with ``marked`` only behind a mark."""
    lead = LEAD.match(text, place)
    if marked and not any(lead.groups()):
        return None
    token = TOKEN.match(text, lead.end())
    if not token or not any("0" <= c <= "9" for c in token[0]):
        return None
    end = token.end()
    while sum(c.isalnum() for c in token[0]) < 6 and (group := GROUP.match(text, end)):
        end = group.end()
    some = [c for c in text[token.start():end] if c.isalnum()]
    follows = text[end:end + 1]
    if not 6 <= len(some) <= 34 or sum("0" <= c <= "9" for c in some) < 3 or follows.isalnum() or follows == "@":
        return None
    return token.start(), end


def longest_iban(raw: str) -> int:
    """Length of the longest part from the beginning that is an IBAN; 0 if none."""
    for end in range(len(raw), 14, -1):
        if raw[end - 1] != " " and iban_holds(raw[:end].replace(" ", "")):
            return end
    return 0


def listed(found: dict[str, list[tuple[int, int]]], kinds: tuple[str, ...]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k in kinds for a, b in sorted(found[k]))


def find(docs: DataFrame, text: str = "text") -> DataFrame:
    """Narrow: appends n_email, n_ip, n_card, n_phone, base_sha256 and spans."""
    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        found = [spans(x) for x in texts(batch, text)]
        return [*[pa.array([len(f[k]) for f in found], pa.int64()) for k in BASE],
                pa.array([hashlib.sha256(listed(f, BASE).encode()).hexdigest() for f in found], pa.string()),
                pa.array([listed(f, KINDS) for f in found], pa.string())]

    return annotate(docs, run, [*[T.StructField(f"n_{k}", T.LongType()) for k in BASE], T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType())])


def masked(text: str) -> str:
    """The text with a mark such as <EMAIL> in place of each span; overlapping spans become one, under the kind that begins first."""
    out, at = [], 0
    for a, b, kind in sorted((a, -b, k) for k, some in spans(text).items() for a, b in some):
        if a < at:
            at = max(at, -b)
            continue
        out += [text[at:a], f"<{kind.upper()}>"]
        at = -b
    return "".join(out) + text[at:]


def redact(docs: DataFrame, text: str = "text", n_chars: str | None = "n_chars") -> DataFrame:
    """Same rows and columns; spans are masked, and ``n_chars`` counts anew where the text has changed. Null stays null."""
    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        return [pa.array([None if x is None else masked(x) for x in batch.column(batch.schema.get_field_index(text)).to_pylist()], pa.string())]

    out = annotate(docs, run, [T.StructField("__masked", T.StringType())])
    counted = {n_chars: F.when(F.col(text).eqNullSafe(F.col("__masked")), F.col(n_chars)).otherwise(F.length("__masked").cast(docs.schema[n_chars].dataType))} if n_chars in docs.columns else {}
    return out.withColumns({text: F.col("__masked")} | counted).drop("__masked").select(*docs.columns)
