"""Secret scans with a random forest against false positives.

Candidates are values assigned to a telling name, strings that begin like a
known kind of key, private key blocks, and all words of 12 characters or more
that mix letters and digits, addresses and paths among them.  A forest decides
on each: candidate length, transitions between kinds of characters, dictionary
coverage, whether it lies in a path, and the neighbouring words.  The forest is
grown in numpy from labelled findings; ``labelled_findings`` makes a seeded set
where none are at hand.

Places are code points of the whole text.  Defined results: a null or empty
text has no findings; a text of any length is scanned in one pass; candidates
do not overlap (named ones first, then the one that starts first, then the longer).
"""

from __future__ import annotations

import base64
import hashlib
import random
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonekeep.llm.words import batches

# Names that keys are assigned to, beginnings of known kinds of keys, and common words.
KEY_NAME = r"(?:token|secret|passw(?:or)?d|passwd|pwd|passphrase|api[_-]?key|apikey|access[_-]?key|auth(?:orization)?|bearer|credential|private[_-]?key|client[_-]?key|signing[_-]?key|encryption[_-]?key)"
BEGINNINGS = ("AKIA", "ASIA", "ghp_", "gho_", "ghs_", "github_pat_", "glpat-", "xoxb-", "xoxp-", "xoxa-", "sk_live_", "rk_live_", "sk-", "AIza", "ya29.", "eyJ", "SG.", "npm_", "dckr_pat_")
PLACEHOLDERS = tuple("example sample dummy placeholder changeme change_me redacted removed hidden masked your insert replace todo none null undefined default test foobar xxx abc123 qwerty secret password token enter here".split())
BENIGN = re.compile(r"\b(?:commit|sha\d*|md5|checksum|digest|hash|etag|uuid|guid|revision|rev|build|version|isbn|doi|id|ref|blob|tree|fingerprint|signature|serial)\b", re.IGNORECASE)
TELLING = re.compile(KEY_NAME, re.IGNORECASE)
COMMON = tuple(
    "the and for that with this from are was not but have has had they you all can her his one our out day get him how man new now old see two way who boy did its let put say she too use about after again also been before being between both came come could each even first found give good great hand here home house into just know large last life like line little long look made make many more most much must name never number only other over part people place right same should small some still such take tell than their them then there these thing think time turn under until very want water well went were what when where which while will word work world would write year main data file user login server client config index value table query model image report order account service system public private admin local global source target string format request response session update create delete select".split()
)
_ASSIGNED = re.compile(rf"(?:^|[^\w])([\w.\-]{{0,40}}{KEY_NAME}[\w.\-]{{0,24}})[\"'\])]*\s*$", re.IGNORECASE)
_NESTED = re.compile(rf"[\"']?[\w.\-]{{0,40}}{KEY_NAME}[\w.\-]{{0,24}}[\"']?\s?[=:]", re.IGNORECASE)
_LEAD = re.compile(r"[=>]?\s*+(?:(?:bearer|basic)\s++)?", re.IGNORECASE)
_QUOTED = re.compile(r"\"([^\"\n]{4,}+)\"|'([^'\n]{4,}+)'")
# a value without quotes goes to the next blank, or to a quote that closes something around it
_OPEN = re.compile(r"(?:[^\s\"'`]++|[\"'`](?![\s,;:)\]}>&]|\Z))*+")
_SEPARATOR = re.compile(r"[&#]")
# marks of lists and of markup after a value
_AFTER = re.compile(r"(?:[,;]|###+|%%%+|\*\*\*+)\Z")
_MARK = re.compile("[=:]")
_LONG = re.compile(r"[A-Za-z0-9+/=_\-.]{20,}")
_MIXED = re.compile(r"[A-Za-z0-9+/=_\-.@:]{12,}")
_BLOCK = re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----.*?(?:-----END [A-Z ]*PRIVATE KEY-----|\Z)", re.DOTALL)
_KNOWN_WORDS = re.compile("|".join(sorted({w for w in COMMON + PLACEHOLDERS if len(w) > 3}, key=lambda w: (-len(w), w))))
_VOWELS = frozenset("aeiouAEIOU")
_UUID = re.compile(r"[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}\Z", re.IGNORECASE)
#: Characters of the neighbourhood on each side that the forest looks at.
NEAR = 48
#: A candidate is a secret from this share of trees on.
THRESHOLD = 0.5
FEATURES = ("length", "distinct", "digits", "upper", "hexadecimal", "transitions", "vowels", "dictionary", "placeholder", "slashes", "path", "dots", "uuid", "assigned", "telling", "benign", "quoted", "known", "run", "symbols")


def find_candidates(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of candidates in order, kinds block, assigned, known and long."""
    found: list[tuple[int, int, str]] = []
    if "-----BEGIN" in text:
        found += [(m.start(), m.end(), "block") for m in _BLOCK.finditer(text)]
    unquoted, end, part = set(), 0, 0
    for mark in _MARK.finditer(text):
        if not (name := _ASSIGNED.search(text, max(0, mark.start() - 72), mark.start())):
            continue
        at = _LEAD.match(text, mark.end()).end()
        if _NESTED.match(text, at):  # an assignment in the value has the value of its own
            continue
        if m := _QUOTED.match(text, at):
            if m[m.lastindex].strip():
                found.append((*m.span(m.lastindex), "assigned"))
            continue
        at += text[at : at + 1] in ("\"", "'", "`")
        if at >= end:  # values that start in one word end where it ends
            end, part = _OPEN.match(text, at).end(), 0
        stop = end
        if text[max(0, name.start(1) - 1) : name.start(1)] in ("?", "&"):  # in a query string the next separator ends it
            if at >= part:
                part = m.start() if (m := _SEPARATOR.search(text, at, end)) else end
            stop = part
        if stop - at >= 4:
            found.append((at, stop, "assigned"))
            unquoted.add((at, stop))
    for begin in BEGINNINGS:
        at = text.find(begin)
        while at >= 0:
            if at == 0 or not (text[at - 1].isalnum() or text[at - 1] == "_"):
                m = _LONG.match(text, at)
                if m:
                    found.append((at, m.end(), "known"))
            at = text.find(begin, at + len(begin))
    at = 0
    for word in text.split():
        if len(word) >= 12:
            at = text.index(word, at)
            for m in _MIXED.finditer(text, at, at + len(word)):
                value = m[0]
                if any(c.isdigit() for c in value) and any(c.isalpha() for c in value):
                    found.append((m.start(), m.end(), "long"))
            at += len(word)
    kept: list[tuple[int, int, str]] = []
    for long in (False, True):  # a long word that holds a named value gives way to it
        part = sorted((x for x in found if (x[2] == "long") == long), key=lambda x: (x[0], -x[1]))
        before, taken, last = iter([*kept, (len(text) + 1, len(text) + 1, "")]), [], 0
        ahead = next(before)
        for one in part:
            while ahead[1] <= one[0] and ahead[2]:
                ahead = next(before)
            if one[0] >= last and one[1] <= ahead[0]:
                taken.append(one)
                last = one[1]
        if not long:
            taken = [one if one[:2] not in unquoted else (one[0], _trimmed(text, *one[:2]), one[2]) for one in taken]
            taken = [one for one in taken if one[2] != "assigned" or one[1] - one[0] >= 4]
        kept = sorted(kept + taken)
    return kept


def _trimmed(text: str, start: int, end: int) -> int:
    """The end of a value without quotes, before separators, markup and brackets that close what was opened before it."""
    value = text[start:end]
    spare = {c: value.count(c) - value.count(o) for o, c in ("()", "[]", "{}", "<>")}
    while end > start:
        last = text[end - 1]
        if spare.get(last, 0) > 0:
            spare[last] -= 1
            end -= 1
        elif m := _AFTER.search(text[max(start, end - 64) : end]):
            end -= len(m[0])
        else:
            break
    return end


def _kind(c: str) -> int:
    return 0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3


def features(value: str, before: str, after: str, kind: str) -> list[float]:
    """The numbers that the forest decides on, in order of FEATURES."""
    n = len(value)
    low = value.lower()
    kinds = [_kind(c) for c in value]
    letters = [c for c in value if c.isalpha()]
    covered = sum(map(len, _KNOWN_WORDS.findall(low)))
    near = f"{before[-NEAR:]} {after[:NEAR]}"
    longest = longest_run = 1
    for a, b in zip(value, value[1:], strict=False):
        longest_run = longest_run + 1 if a == b else 1
        longest = max(longest, longest_run)
    return [
        float(n),
        len(set(value)) / n,
        sum(k == 2 for k in kinds) / n,
        sum(k == 1 for k in kinds) / n,
        sum(c in "0123456789abcdef" for c in low) / n,
        sum(a != b for a, b in zip(kinds, kinds[1:], strict=False)) / max(n - 1, 1),
        sum(c in _VOWELS for c in letters) / max(len(letters), 1),
        covered / n,
        float(any(p in low for p in PLACEHOLDERS)),
        value.count("/") / n,
        float(bool(re.search(r"(?:https?:|www\.|[\\/]|@)\S*$", before[-NEAR:])) or bool(re.search(r"\.(?:com|net|org|io|js|css|html?|png|jpe?g|py|java|txt|json|xml|gz|zip)\b", low))),
        value.count(".") / n,
        float(bool(_UUID.match(value))),
        float(kind == "assigned"),
        float(bool(TELLING.search(before[-NEAR:]))),
        float(bool(BENIGN.search(near)) and not TELLING.search(before[-NEAR:])),
        float(before[-1:] in "\"'" and before[-1:] != ""),
        float(value.startswith(BEGINNINGS) or kind == "block"),
        longest / n,
        sum(k == 3 for k in kinds) / n,
    ]


class Forest:
    """Binary trees over features, each grown on a bootstrap with random features at every split."""

    def __init__(self, trees: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]):
        self.trees = trees

    @staticmethod
    def grow(x: np.ndarray, y: np.ndarray, trees: int = 30, depth: int = 8, least: int = 3, seed: int = 5) -> Forest:
        rng = np.random.default_rng(seed)
        out = []
        for _ in range(trees):
            pick = rng.integers(0, len(y), len(y))
            nodes: list[list[float]] = []

            def split(rows: np.ndarray, level: int, nodes=nodes) -> int:
                me = len(nodes)
                nodes.append([-1, 0.0, -1, -1, float(y[rows].mean())])
                if level == depth or len(rows) < 2 * least or y[rows].min() == y[rows].max():
                    return me
                best = (1e-9, -1, 0.0)
                for j in rng.permutation(x.shape[1])[: int(np.ceil(np.sqrt(x.shape[1])))]:
                    order = rows[np.argsort(x[rows, j], kind="stable")]
                    v, s = x[order, j], np.cumsum(y[order])
                    n = np.arange(1, len(order))
                    rest = len(order) - n
                    fits = (v[1:] > v[:-1]) & (n >= least) & (rest >= least)
                    if not fits.any():
                        continue
                    mean = s[-1] / len(order)
                    gain = np.where(fits, n * (s[:-1] / n - mean) ** 2 + rest * ((s[-1] - s[:-1]) / rest - mean) ** 2, -1)
                    i = int(gain.argmax())
                    if gain[i] > best[0]:
                        best = (float(gain[i]), int(j), float((v[i] + v[i + 1]) / 2))
                if best[1] < 0:
                    return me
                left = x[rows, best[1]] <= best[2]
                nodes[me][0], nodes[me][1] = best[1], best[2]
                nodes[me][2] = split(rows[left], level + 1)
                nodes[me][3] = split(rows[~left], level + 1)
                return me

            split(pick, 0)
            t = np.array(nodes)
            out.append((t[:, 0].astype(int), t[:, 1], t[:, 2].astype(int), t[:, 3].astype(int), t[:, 4]))
        return Forest(out)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        for feature, cut, left, right, value in self.trees:
            at = np.zeros(len(x), int)
            for _ in range(64):
                inner = feature[at] >= 0
                if not inner.any():
                    break
                low = x[np.arange(len(x)), np.maximum(feature[at], 0)] <= cut[at]
                at = np.where(inner, np.where(low, left[at], right[at]), at)
            total += value[at]
        return total / max(len(self.trees), 1)


def labelled_findings(n: int = 5000, seed: int = 3) -> list[tuple[str, str, str, str, int]]:
    """Seeded findings (value, text before, text after, kind, is a secret) of the sorts that scans meet."""
    rng = random.Random(seed)
    alnum = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    draw = lambda chars, k: "".join(rng.choice(chars) for _ in range(k))
    syllables = "the an er ing tion re on at en nd ti es or ed is it al ar st to nt ha ent ion eau ung sch mente cion".split()
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 5)))
    prose = lambda: " ".join(word() for _ in range(rng.randint(0, 5)))
    hexa = lambda k: draw("0123456789abcdef", k)
    names = "token secret password passwd api_key API_KEY apikey access_key auth_token client_secret DB_PASSWORD private_key pwd".split()
    benign_names = "commit sha1 sha256 md5 checksum uuid build revision id etag version digest".split()
    out = []
    for _ in range(n):
        secret = rng.random() < 0.5
        if secret:
            way = rng.randint(0, 6)
            value = (
                hexa(rng.choice([16, 18, 20, 24, 32, 40, 48, 64])) if way <= 1
                else draw(alnum, rng.randint(10, 48)) if way == 2
                else base64.b64encode(rng.randbytes(rng.randint(12, 48))).decode() if way == 3
                else rng.choice(BEGINNINGS) + draw(alnum, rng.randint(16, 40)) if way == 4
                else draw(alnum + "!@^-_.*#&$%|;<>(){}[]", rng.randint(8, 24)) if way == 5
                else draw("abcdefghijklmnopqrstuvwxyz0123456789", rng.randint(12, 40))
            )
            if rng.random() < 0.1:
                body = "\n".join(base64.b64encode(rng.randbytes(48)).decode() for _ in range(rng.randint(0, 20)))
                value = f"-----BEGIN {rng.choice(['', 'RSA ', 'EC '])}PRIVATE KEY-----\n{body}\n-----END PRIVATE KEY-----"
                kind, before, after = "block", f"{prose()} ", f" {prose()}"
            elif way == 4 and rng.random() < 0.5:
                kind, before, after = "known", f"{prose()} ", f" {prose()}"
            else:
                quote = rng.choice(["", '"', "'"])
                kind, before, after = "assigned", f"{prose()} {rng.choice(names)}{rng.choice(['=', ' = ', ': '])}{quote}", f"{quote}{rng.choice(['', '### ', '%%% ', '. '])} {prose()}"
        else:
            way = rng.randint(0, 10)
            kind = "long"
            before, after = f"{prose()} {rng.choice(benign_names)}{rng.choice([' ', ': ', '='])}", f" {prose()}"
            if way <= 1:
                value = hexa(rng.choice([32, 40, 64]))
            elif way == 2:
                value = str(uuid.UUID(int=rng.getrandbits(128)))
            elif way == 3:
                value = "/".join(word() for _ in range(rng.randint(3, 6))) + f"/{rng.randint(1, 9999)}.html"
                before = f"{prose()} {rng.choice(['https://', '/', 'www.'])}"
            elif way == 4:
                value, kind = rng.choice(["your_{}_here", "<{}>", "example-{}", "changeme", "xxxxxxxxxxxx", "{}_placeholder", "dummy_{}", "test-{}", "None", "null"]).format(rng.choice(names)), "assigned"
                before = f"{prose()} {rng.choice(names)}{rng.choice(['=', ' = ', ': '])}"
            elif way == 5:
                value, kind = word() + rng.choice(["", ",", "."]), "assigned"
                value = value if len(value) >= 4 else value + "tion"
                before = f"{prose()} {rng.choice(names)}: "
            elif way == 6:
                value = "-".join(word() for _ in range(rng.randint(3, 6))) + f"-{rng.randint(1, 99)}"
                before = f"{prose()} "
            elif way == 7:
                value = f"{word()}.{word()}.{rng.randint(1, 99)}@{word()}.example.com"
                before = f"{prose()} "
            elif way == 8:
                day = f"20{rng.randint(10, 29)}-{rng.randint(1, 12):02d}-{rng.randint(1, 28):02d}"
                value = rng.choice([
                    f"{day}T{rng.randint(0, 23):02d}:{rng.randint(0, 59):02d}:{rng.randint(0, 59):02d}{rng.choice(['Z', '+00:00', '.000Z', ''])}",
                    f"{rng.randint(0, 20)}.{rng.randint(0, 40)}.{rng.randint(0, 9)}-{rng.choice(['beta', 'rc', 'alpha', 'dev'])}.{rng.randint(1, 20)}+build.{day.replace('-', '')}",
                    f"{day}-{word()}-{word()}.{rng.choice(['log', 'txt', 'csv', 'tar.gz'])}",
                    f"v{rng.randint(0, 20)}.{rng.randint(0, 40)}.{rng.randint(0, 9)}-{hexa(8)}",
                ])
                before = f"{prose()} {rng.choice(['', 'at ', 'on ', 'version ', 'since '])}"
            elif way == 9:
                value, kind = rng.choice("*x.-_#•") * rng.randint(4, 24), "assigned"
                quote = rng.choice(["", '"', "'"])
                before, after = f"{prose()} {rng.choice(names)}{rng.choice(['=', ' = ', ': '])}{quote}", f"{quote} {prose()}"
            else:
                value, kind = rng.choice(["os.environ", "get_secret()", "config.token", "process.env.TOKEN", "args.password", "self.password", "getpass.getpass", "getpass.getpass()", "${TOKEN}", "$PASSWORD", "{{secret}}", "%(password)s", "os.environ['TOKEN']", "<password>"]), "assigned"
                before = f"{prose()} {rng.choice(names)} = "
        out.append((value, before, after, kind, int(secret)))
    return out


def train(findings: list[tuple[str, str, str, str, int]]) -> Forest:
    x = np.array([features(v, b, a, k) for v, b, a, k, _ in findings])
    return Forest.grow(x, np.array([f[4] for f in findings], float))


def scan_text(text: str, forest: Forest) -> list[tuple[int, int, str, float]]:
    """(start, end, kind, score) of the candidates of a text."""
    found = find_candidates(text)
    if not found:
        return []
    x = np.array([features(text[a:b], text[max(0, a - 2 * NEAR) : a], text[b : b + 2 * NEAR], k) for a, b, k in found])
    return [(a, b, k, float(s)) for (a, b, k), s in zip(found, forest.score(x), strict=True)]


def scan_documents(docs: DataFrame, forest: Forest, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, begin, end, kind, score, is_secret and value_sha256 of every candidate of every whole text."""
    schema = "doc_id long, begin int, end int, kind string, score double, is_secret boolean, value_sha256 string"

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for a, b in batches(part.column(1)):
                rows = []
                for doc_id, text in zip(part.column(0).slice(a, b - a).to_pylist(), part.column(1).slice(a, b - a).to_pylist(), strict=True):
                    for begin, end, kind, score in scan_text(text or "", forest):
                        rows.append((doc_id, begin, end, kind, score, score >= threshold, hashlib.sha256(text[begin:end].encode()).hexdigest()))
                columns = list(zip(*rows, strict=True)) or [[]] * 7
                types = (pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.float64(), pa.bool_(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=[x.split()[0] for x in schema.split(", ")])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def redact_documents(docs: DataFrame, forest: Forest, mark: str = "[SECRET]", threshold: float = THRESHOLD) -> DataFrame:
    """All columns of ``docs`` with the secrets in ``text`` replaced by ``mark``; ``n_chars`` follows, where there is one."""
    names = docs.columns

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = names.index("text")
        for part in parts:
            for a, b in batches(part.column(at)):
                piece = part.slice(a, b - a)
                texts, changed = piece.column(at).to_pylist(), {}
                for i, text in enumerate(texts):
                    spans = [(x, y) for x, y, _, s in scan_text(text or "", forest) if s >= threshold]
                    if spans:
                        out, last = [], 0
                        for x, y in spans:
                            out += [text[last:x], mark]
                            last = y
                        changed[i] = "".join(out) + text[last:]
                if changed:
                    columns = piece.columns
                    columns[at] = pa.array([changed.get(i, t) for i, t in enumerate(texts)], columns[at].type)
                    if "n_chars" in names:
                        k = names.index("n_chars")
                        columns[k] = pa.array([len(changed[i]) if i in changed else n for i, n in enumerate(columns[k].to_pylist())], columns[k].type)
                    piece = pa.RecordBatch.from_arrays(columns, names=names)
                yield piece

    return docs.mapInArrow(run, docs.schema)
