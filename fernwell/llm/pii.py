"""Personal data by candidate gradient boosting.

Generators of high recall propose spans that may overlap; boosted trees read their format and
context; thresholds, calibrated per kind on rows kept from training, select what is redacted.
Spans of the four base patterns always stay; the trees decide on every other candidate (secrets such
as keys and tokens, national phone numbers, obfuscated addresses, cards with unusual separators,
IPv6 and defanged addresses, numbers that fail a check).

The trees are trained on synthetic text made from a seed, not on the corpus, so that the model is
the same for every input. Training, calibration and test texts are written with cues, names, hosts
and value formats of their own, so that thresholds are set, and precision and recall measured, on
text unlike what the trees saw. One pass over the texts, no shuffle; each text is read whole.

Cases: a null text is empty and has no spans; equal rows give equal results; an empty table gives
no rows; extra columns are ignored; very long texts take time linear in their length, also runs of
one character.
"""

from __future__ import annotations

import hashlib
import random
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .boosting import BoostedTrees
from .shared import bounded_batches

KINDS = ("email", "ip", "card", "phone", "secret")
EMAIL, IP, CARD, PHONE, SECRET = range(5)

# The lookbehinds change no match: a start inside a run of digits can only succeed if the start of
# the run does. They keep long runs linear.
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_HOST = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_SET = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DIGIT = re.compile(r"[0-9]")
_LETTER = re.compile(r"[A-Za-z]")
_NOT_DIGIT = re.compile(r"[^0-9]")

Span = tuple[int, int, int]  # start, kind, end


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_SET:
            start -= 1
        m = _HOST.match(text, at) if start < at else None
        if m:
            yield start, EMAIL, m.end()
            done = m.end()
        else:
            done = max(done, at)  # nothing before this sign can be part of a later match
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> tuple[list[Span], list[Span]]:
    """Spans of the base patterns, and matches of their shapes that fail the checks."""
    found, failed = [], []
    if "@" in text:
        found += _emails(text)
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            s = (m.start(), IP, m.end())
            ok = all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))
            (found if ok else failed).append(s)
        for m in _CARD.finditer(text):
            if m.end() - m.start() < 12:
                continue
            d = _NOT_DIGIT.sub("", m[0])
            if 12 <= len(d) <= 19:
                (found if luhn(d) else failed).append((m.start(), CARD, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                n = len(_NOT_DIGIT.sub("", m[0]))
                (found if 9 <= n <= 15 else failed).append((m.start(), PHONE, m.end()))
    found.sort()
    return found, failed


# -------------------------------------------------------------------------------- more candidates

_GENERATORS: tuple[tuple[int, str, re.Pattern], ...] = (
    (EMAIL, "(at)", re.compile(r"[A-Za-z0-9._%+-]{1,64} ?[(\[]at[)\]] ?[A-Za-z0-9-]{1,63}(?: ?(?:\.|[(\[]dot[)\]]) ?[A-Za-z0-9-]{1,63}){1,6}")),
    (EMAIL, " dot ", re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64} at [A-Za-z0-9-]{1,63}(?: dot [A-Za-z0-9-]{1,63}){1,4}")),
    (IP, ":", re.compile(r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])")),
    (IP, "[.]", re.compile(r"(?<![0-9])[0-9]{1,3}(?:(?:\[\.\]|\.)[0-9]{1,3}){3}(?![0-9])")),
    (CARD, "", re.compile(r"(?<![0-9])[0-9]{4}(?:[._/][0-9]{4}){3}(?![0-9])")),
    (PHONE, "", re.compile(r"(?<![0-9A-Za-z+.])(?:\([0-9]{2,5}\) ?|0[0-9]{1,4}[\x20/-])[0-9]{3,8}(?:[\x20.-][0-9]{2,5}){0,3}(?![0-9])")),
    (PHONE, "", re.compile(r"(?<![0-9A-Za-z+.-])[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}(?![0-9.-])")),
    (SECRET, "", re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{12,}={0,2}")),
)

_CONTEXT = (
    re.compile(r"mail|contact|reach|write", re.I),
    re.compile(r"\bip\b|host|server|address|addr", re.I),
    re.compile(r"card|visa|credit|debit|amex|\bcc\b", re.I),
    re.compile(r"tel|phone|call|fax|mobile|cell", re.I),
    re.compile(r"version|order|isbn|\bid\b|\bno\b|date|page|ref|total", re.I),
    re.compile(r"token|secret|key|passw|pwd|auth|credential|bearer", re.I),
    re.compile(r"commit|sha|md5|hash|digest|checksum|uuid|https?:", re.I),
)
_TLDS = frozenset("com org net edu gov io de fr es it uk eu info".split())
_N_FEATURES = 34


class _Taken:
    """Stretches that do not overlap, in order; an asked one is looked up by its place."""

    def __init__(self) -> None:
        self.starts: list[int] = []
        self.ends: list[int] = []

    def free(self, start: int, end: int) -> bool:
        k = bisect_left(self.starts, end)
        return k == 0 or self.ends[k - 1] <= start

    def add(self, start: int, end: int) -> None:
        """A stretch; one that overlaps the last widens it."""
        k = bisect_right(self.starts, start)
        if k and self.ends[k - 1] > start:
            self.ends[k - 1] = max(self.ends[k - 1], end)
        else:
            self.starts.insert(k, start)
            self.ends.insert(k, end)


def proposals(text: str, base: list[Span], failed: list[Span]) -> list[Span]:
    """Candidates besides the base spans; they may overlap each other, not a base span."""
    out = list(failed)
    digits = bool(_DIGIT.search(text))
    for kind, gate, pattern in _GENERATORS:
        if kind == EMAIL and gate == "(at)":
            if "(at)" not in text and "[at]" not in text:
                continue
        elif gate and gate not in text:
            continue
        if kind != EMAIL and not digits:
            continue
        found = pattern.finditer(text)
        out += [(m.start(), kind, m.end()) for m in found if kind != SECRET or (_DIGIT.search(m[0]) and _LETTER.search(m[0]))]
    if out and base:
        taken = _Taken()
        for s, _, e in sorted(base):
            taken.add(s, e)
        out = [c for c in out if taken.free(c[0], c[2])]
    return sorted(set(out))


def features(text: str, spans: list[Span]) -> np.ndarray:
    """Format and context of each span."""
    out = np.zeros((len(spans), _N_FEATURES))
    for i, (start, kind, end) in enumerate(spans):
        body = text[start:end]
        before, after = text[max(0, start - 28) : start], text[end : end + 12]
        digits = _NOT_DIGIT.sub("", body)
        groups = re.findall(r"[0-9]+", body)
        ctx = [bool(p.search(before)) for p in _CONTEXT]
        tail = re.split(r"[^A-Za-z0-9]+", body.lower())[-1]
        n = len(body)
        changes = sum(a.isdigit() != b.isdigit() for a, b in zip(body[:64], body[1:65]))
        out[i] = (
            kind == EMAIL, kind == IP, kind == CARD, kind == PHONE, kind == SECRET,
            len(digits), luhn(digits) if digits else 0, min(n, 500), len(groups),
            len(groups[0]) if groups else 0, len(groups[-1]) if groups else 0,
            max((int(g) for g in groups if len(g) < 6), default=0), len(set(digits)),
            before[-1:].isalnum(), after[:1].isalnum(), "+" in body, "(" in body,
            *ctx, tail in _TLDS, body.count(":"), bool(re.search(r"[(\[](at|dot)[)\]]| at .* dot |\[\.\]", body)),
            before[-1:] in "\"'" and before != "", bool(re.search(r"[=:][\x20\"']{0,2}$", before)),
            len(digits) / n, sum(c.isupper() for c in body[:64]) / min(n, 64), len(set(body[:64])) / min(n, 64),
            changes / min(n, 64), body.count("-") + body.count("/"),
        )
    return out


# ------------------------------------------------------------------------------------- the model


def _digits(r: random.Random, n: int) -> str:
    return "".join(r.choice("0123456789") for _ in range(n))


def _hex(r: random.Random, n: int) -> str:
    return "".join(r.choice("0123456789abcdef") for _ in range(n))


def _card(r: random.Random) -> str:
    head = r.choice("3456") + _digits(r, 14)
    return next(head + c for c in "0123456789" if luhn(head + c))


def _mixed(r: random.Random, n: int, letters: str = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") -> str:
    return "".join(r.choice(letters) for _ in range(n - 1)) + r.choice("0123456789")


#: For the training, the calibration and the test texts: what they are written with.
_NAMES = (["anna.berg", "jsmith", "m_ito", "info"], ["li.wei7", "sales", "o.neill"], ["k-petrov", "team42", "r.gomez"])
_HOSTS = (["mail", "example", "uni-x"], ["shop3", "acme-corp"], ["post", "dept9"])
_FILLER = ("words of the rest this that old".split(), "und der haus wenn aber dort".split(), "la casa que por mucho tiempo".split())
_CUES = {
    "email": (["mail me: ", "contact ", ""], ["e-mail ", "reach us at ", ""], ["write to ", "Contact: ", ""]),
    "ip": (["ip ", "server ", ""], ["host address ", "IP: ", ""], ["addr ", "hosts: ", ""]),
    "card": (["card ", "visa ", ""], ["credit card no ", "amex ", ""], ["pay by card ", "debit ", ""]),
    "phone": (["tel ", "call ", ""], ["phone: ", "fax ", ""], ["mobile ", "Tel. ", ""]),
    "secret": (["api_key = \"", "token: ", "password=", "secret key "], ["token = \"", "auth_token: '", "Bearer ", "PWD: "], ["access key = ", "SECRET=\"", "passwd ", "client credential: "]),
    "none": (["version ", "order ", "id ", "page ", ""], ["isbn ", "ref ", "Order: ", ""], ["total ", "no ", "date ", ""]),
    "digest": (["commit ", "sha256: ", "see https://x.org/", ""], ["md5 = ", "checksum ", "uuid: ", ""], ["digest ", "hash: ", "http://a.b/c/", ""]),
}


def _sample(r: random.Random, part: int) -> tuple[str, str, str, int]:
    """Words before, the value, words after, whether it is personal data. part: 0 for training, 1
    for calibration, 2 for tests, which have cues, names, hosts and separators of their own."""
    name, host = r.choice(_NAMES[part]), r.choice(_HOSTS[part])
    tld = r.choice((["com", "org", "de"], ["net", "io"], ["edu", "fr"])[part])
    cue = lambda kind: r.choice(_CUES[kind][part])
    own = lambda *options: options[part]
    k = r.randrange(20)
    label, kind = 1, "none"
    if k == 0:
        kind, v = "email", f"{name}{r.choice(own([' (at) ', '(at)'], [' [at] ', '(at) '], ['[at]', ' (at)']))}{host}.{tld}"
    elif k == 1:
        kind, v = "email", f"{name} at {host} dot {tld}"
    elif k == 2:
        kind, v = "ip", ":".join(f"{r.randrange(65536):{own('x', '04x', 'x')}}" for _ in range(8))
    elif k == 3:
        kind, v = "ip", own("[.]", "[.]", "[.]").join(str(r.randrange(256)) for _ in range(4))
    elif k == 4:
        c = _card(r)
        kind, v = "card", r.choice(own("._", "/.", "_/")).join(c[i : i + 4] for i in range(0, 16, 4))
    elif k == 5:
        kind, v = "phone", own(f"({_digits(r, 3)}) {_digits(r, 3)}-{_digits(r, 4)}", f"({_digits(r, 4)}) {_digits(r, 6)}", f"({_digits(r, 3)}){_digits(r, 3)}.{_digits(r, 4)}")
    elif k == 6:
        kind, v = "phone", f"0{_digits(r, 3)}{own(' ', '/', '-')}{_digits(r, r.choice([5, 6, 7]))}"
    elif k == 7:
        kind, v = "phone", f"{_digits(r, 3)}{own('-', '.', '-')}{_digits(r, 3)}{own('-', '-', '.')}{_digits(r, 4)}"
    elif k in (8, 9):  # keys, tokens and passwords beside a word that says so
        kind = "secret"
        v = r.choice(
            own(
                [_hex(r, 32), _mixed(r, 24), _mixed(r, 40)],
                [_hex(r, 40), "k_" + _mixed(r, 30), _mixed(r, 20) + "=="],
                [_hex(r, 64), _mixed(r, 36), "pk-" + _mixed(r, 28)],
            )
        )
    elif k in (10, 11, 12):  # the same shapes as digests, identifiers and parts of addresses
        label, kind = 0, "digest"
        u = _hex(r, 32)
        v = r.choice([_hex(r, r.choice([32, 40, 64])), f"{u[:8]}-{u[8:12]}-{u[12:16]}-{u[16:20]}-{u[20:]}", "/".join([name, host, "part" + _digits(r, 3), "page"])])
    elif k == 13:  # names and long words with a number in them
        label = 0
        v = r.choice(["_".join(r.choices(_FILLER[part], k=3)) + _digits(r, 2), "-".join(r.choices(_FILLER[part], k=4)) + "-" + _digits(r, 4), _digits(r, r.choice([12, 13, 18, 20, 24]))])
        if v.isdigit() and luhn(v):
            v = v[:-1] + str((int(v[-1]) + 1) % 10)
    elif k in (14, 15):  # a number of a card's length that fails the check
        v = _digits(r, r.choice([12, 13, 14, 15, 16, 16, 16, 18, 19]))
        label, kind = 0, r.choice(["none", "card"])
        v = v if not luhn(v) else v[:-1] + str((int(v[-1]) + 1) % 10)
    elif k == 16:
        v = ".".join(_digits(r, 4) for _ in range(4))
        label, v = 0, v if not luhn(v.replace(".", "")) else "1234.1234.1234.1234"
    elif k == 17:  # versions and dates
        label = 0
        v = r.choice([f"{r.randrange(300, 999)}.{r.randrange(99)}.{r.randrange(9)}.{r.randrange(999)}", f"0{r.randrange(1, 9)}-{_digits(r, 4)}", f"({r.randrange(1900, 2030)}) {_digits(r, 4)}"])
    elif k == 18:
        label, v = 0, f"{r.choice(own(['arrive', 'stop'], ['turn', 'wait'], ['look', 'meet']))} at {r.choice(['every', 'each', 'red'])} dot {r.choice(['there', 'now', 'then'])}"
    else:
        label = 0
        v = r.choice([f"{_digits(r, 3)}-{_digits(r, 3)}-{_digits(r, 4)}", "+" + r.choice([_digits(r, 4) + " " + _digits(r, 2), _digits(r, 17)])])
        return own(r.choice(["isbn ", "order "]), "ref ", "no "), v, " is", 0
    before = cue(kind)
    closing = before[-1:] if before[-1:] in "\"'" and before else ""
    return before, v, closing + r.choice([" the", ", ", ".", "\n"]), label


def samples(seed: int, n: int, part: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features, labels and kinds of n candidates in synthetic texts."""
    r = random.Random(seed)
    rows, labels, kinds = [], [], []
    while len(rows) < n:
        before, value, after, label = _sample(r, part)
        head = " ".join(r.choices(_FILLER[part], k=r.randrange(1, 6))) + " "
        text = head + before + value + after + " " + " ".join(r.choices(_FILLER[part], k=3))
        at = len(head + before)
        base, failed = base_spans(text)
        for c in proposals(text, base, failed):
            inside = c[0] < at + len(value) and c[2] > at and min(c[2], at + len(value)) - max(c[0], at) >= 0.8 * max(len(value), c[2] - c[0])
            rows.append(features(text, [c])[0])
            labels.append(label if inside else 0)
            kinds.append(c[1])
    return np.array(rows), np.array(labels, float), np.array(kinds)


@lru_cache(maxsize=4)
def model(seed: int = 7, n: int = 4000, precision: float = 0.98) -> tuple[BoostedTrees, tuple[float, ...]]:
    """The trees and the threshold of each kind: the least one at which the wanted share of the
    spans accepted on the calibration texts is right."""
    x, y, _ = samples(seed, n, 0)
    xc, yc, kc = samples(seed + 1, n // 2, 1)
    trees = BoostedTrees().fit(x, y).calibrate(xc, yc)
    p = trees.predict(xc)
    limits = []
    for k in range(len(KINDS)):
        own = kc == k
        limit = 0.99
        for t in np.linspace(0.05, 0.95, 37):
            took = own & (p >= t)
            if not took.any() or yc[took].mean() >= precision:
                limit = float(t)
                break
        limits.append(limit)
    return trees, tuple(limits)


def find(text: str, trees: BoostedTrees, limits: tuple[float, ...]) -> tuple[list[Span], list[Span]]:
    """Base spans and added spans of a whole text, each in order."""
    if "@" not in text and not _DIGIT.search(text) and " dot " not in text and "[at]" not in text and "(at)" not in text:
        return [], []
    base, failed = base_spans(text)
    more = proposals(text, base, failed)
    if not more:
        return base, []
    p = trees.predict(features(text, more))
    added: list[Span] = []
    taken = _Taken()
    for i in np.argsort(-p, kind="stable"):
        s = more[i]
        if p[i] >= limits[s[1]] and taken.free(s[0], s[2]):
            added.append(s)
            taken.add(s[0], s[2])
    return base, sorted(added)


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def redact_text(text: str, spans: list[Span]) -> str:
    """Each maximal stretch covered by spans becomes the mark of its first span's kind."""
    out, at, open_kind, open_end = [], 0, -1, -1
    for s, k, e in sorted(spans):
        if s < open_end:
            open_end = max(open_end, e)
            continue
        if open_kind >= 0:
            out.append(f"[{KINDS[open_kind].upper()}]")
            at = open_end
        out.append(text[at:s])
        at, open_kind, open_end = s, k, e
    if open_kind >= 0:
        out.append(f"[{KINDS[open_kind].upper()}]")
        at = open_end
    out.append(text[at:])
    return "".join(out)


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (base spans of each kind), base_sha256, spans,
    n_added (spans that the trees added), n_spans (all of them)."""
    trees, limits = model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols: dict[str, list] = {n: [] for n in ("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added", "n_spans")}
            for doc_id, text in zip(b["doc_id"].to_pylist(), b["text"], strict=True):
                base, added = find(text.as_py(), trees, limits)
                n = [0] * PHONE + [0]
                for _, k, _ in base:
                    n[k] += 1
                row = (doc_id, *n, hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(sorted(base + added)), len(added), len(base) + len(added))
                for c, v in zip(cols.values(), row, strict=True):
                    c.append(v)
            yield pa.RecordBatch.from_pydict(
                {c: pa.array(v, pa.string() if c in ("base_sha256", "spans") else pa.int64()) for c, v in cols.items()}
            )

    slim = bounded_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return slim.mapInArrow(
        run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long, n_spans long"
    )


def redact(docs: DataFrame) -> DataFrame:
    """docs with every found span of text replaced by the mark of its kind; all other columns are
    kept, n_chars (if there) follows the new text; a null text stays null."""
    trees, limits = model()

    @F.pandas_udf("string")
    def clean(texts):  # noqa: ANN001, ANN202
        def one(t):  # noqa: ANN001, ANN202
            if t is None:
                return None
            base, added = find(t, trees, limits)
            return redact_text(t, base + added) if base or added else t

        return texts.map(one, na_action="ignore")

    out = bounded_batches(docs).withColumn("text", clean(F.col("text")))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(kind)))
    return out
