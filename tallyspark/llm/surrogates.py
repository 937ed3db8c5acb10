"""Personal data replaced by surrogates.

Entities are found in every text and brought to a canonical form, so that mentions of one entity, however they
are written, share a surrogate. A surrogate is drawn from a keyed digest of the entity and keeps its type and format: digits
for digits, a valid check digit for a valid one, an address for an address, a name of the same gender and script. The
distinct entities of the corpus are a table; draws that meet another entity's surrogate or a real entity are
drawn again, until all are distinct.
"""

from __future__ import annotations

import hmac
import ipaddress
import re
import unicodedata
from collections.abc import Callable, Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.session import staged

# Titles that tell a person's gender.
MALE = "Mr Mister Sir Herr Herrn Monsieur Señor Sr Don г-н господин κύριος".split()
FEMALE = "Mrs Ms Miss Madam Frau Madame Mme Mademoiselle Mlle Señora Sra Señorita Srta Doña г-жа госпожа κυρία".split()
#: Syllables of invented names, by script; endings by gender.
SYLLABLES = {"LATIN": "ba de fi lo mu na pe ri so tu va ke li mo ra".split(), "CYRILLIC": "ба де фи ло му на пе ри со ту ва ке ли мо ра".split(),
             "GREEK": "βα δε φι λο μυ να πε ρι σο τυ κε λι μο ρα".split()}
ENDINGS = {"LATIN": {"m": "n", "f": "a", "": "l"}, "CYRILLIC": {"m": "н", "f": "я", "": "в"}, "GREEK": {"m": "ος", "f": "η", "": "ης"}}

_HINT = re.compile(r"[0-9@]")
_FOUND = re.compile(
    r"(?P<email>[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,})"
    r"|(?P<ip>(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\w]|\.\d))"
    r"|(?P<ipv6>(?<![\w:.])(?:[0-9A-Fa-f]{0,4}:){2,7}(?:(?:\d{1,3}\.){3}\d{1,3}|[0-9A-Fa-f]{0,4})(?![\w:]|\.\d))"
    r"|(?P<iban>(?<!\w)[A-Z]{2}\d{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?(?!\w))"
    r"|(?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))"
    r"|(?P<international>(?<![\w.])\+(?:\d{7,15}|\d{1,3}[\x20.-]?(?:\(\d{2,4}\)[\x20.-]?|\d{2,4}[\x20.-])\d{3,4}[\x20.-]?\d{3,4})(?![\w]|[.-]\d))"
    r"|(?P<card>(?<![\w-])\d(?:[\x20-]?\d){12,18}(?![\w-]))"
    r"|(?P<phone>(?<![\w.])(?:\+\d{1,3}[\x20.-]?)?(?:\(\d{2,4}\)[\x20.-]?|\d{2,4}[\x20.-])\d{3,4}[\x20.-]?\d{3,4}(?![\w]|[.-]\d))", re.A)
_WORDS = "|".join(sorted((re.escape(t) for t in MALE + FEMALE), key=len, reverse=True))
_TITLE = re.compile(rf"(?<!\w)({_WORDS})\.?[\x20\t]+([^\W\d_][\w'’-]*(?:[\x20\t]+[^\W\d_][\w'’-]*){{0,2}})")
_OWNER = re.compile(r"(?:['’][sS])?['’-]*\Z")
Span = tuple[int, int, str, str]  # start, end, kind, canonical form


def _script(word: str) -> str:
    name = unicodedata.name(word[0], "").split(" ")[0]
    return name if name in SYLLABLES else "LATIN"


def detect(text: str) -> list[Span]:
    """Entities of one text, in order, without overlaps. A person's given and family names are entities of their own.

    A person is found by a title. Once found, each of their names is replaced wherever it stands in the text with a capital, but
    for single letters.
    """
    out: list[Span] = []
    if _HINT.search(text):
        for m in _FOUND.finditer(text):
            kind, raw = m.lastgroup, m[0]
            if kind == "email":
                out.append((*m.span(), kind, raw.lower()))
            elif kind == "ip":
                out.append((*m.span(), kind, ".".join(str(int(p)) for p in raw.split("."))))
            elif kind == "ipv6":
                address = _ipv6(raw)
                if address:
                    out.append((*m.span(), "ip", address))
            else:
                out.append((*m.span(), "phone" if kind == "international" else kind, "".join(c for c in raw if c.isalnum() or c == "+")))
    known: dict[str, tuple[str, str]] = {}
    for m in _TITLE.finditer(text):
        gender = "m" if m[1] in MALE else "f"
        names = [(m.start(2) + w.start(), _OWNER.sub("", w[0])) for w in re.finditer(r"\S+", m[2])]
        upper = 0
        while upper < len(names) and names[upper][1][0].isupper():
            upper += 1
        for n, (at, word) in enumerate(names[:upper]):
            family = n == upper - 1
            name = "family" if family else "given", f"{_script(word)}:{'' if family else gender}:{word.casefold()}"
            out.append((at, at + len(word), *name))
            if len(word) > 1 and (family or word.casefold() not in known):
                known[word.casefold()] = name
    out = _apart(sorted(out))
    if known:
        # Boundaries are those of a title's names, so that a part of a double name stays with it.
        words, taken = re.compile(r"[^\W\d_][\w'’-]*"), 0
        bare = []
        for m in words.finditer(text):
            word = _OWNER.sub("", m[0])
            for at, part in [(m.start(), word)] if word.casefold() in known else [(m.start() + w.start(), w[0]) for w in re.finditer(r"[^-]+", word)]:
                while taken < len(out) and out[taken][1] <= at:
                    taken += 1
                if part[0].isupper() and part.casefold() in known and not (taken < len(out) and out[taken][0] < at + len(part)):
                    bare.append((at, at + len(part), *known[part.casefold()]))
        out = sorted(out + bare)
    return out


def _apart(spans: list[Span]) -> list[Span]:
    """Sorted spans without those that begin before an earlier one ends."""
    out, end = [], 0
    for s in spans:
        if s[0] >= end:
            out.append(s)
        end = max(end, s[1])
    return out


def _ipv6(raw: str) -> str | None:
    """The address in its short form, if it is one and has a digit."""
    try:
        return ipaddress.IPv6Address(raw).compressed if any(c.isdigit() for c in raw) else None
    except ValueError:
        return None


def _luhn(digits: str) -> bool:
    total = sum(d if n % 2 == 0 else d * 2 - 9 * (d > 4) for n, d in enumerate(int(c) for c in reversed(digits)))
    return total % 10 == 0


def draw(kind: str, canonical: str, key: bytes, attempt: int) -> str:
    """Canonical form of the surrogate of an entity, at the given attempt."""
    bits = int.from_bytes(b"".join(hmac.digest(key, f"{kind}|{canonical}|{attempt}|{n}".encode(), sha256) for n in range(1 + len(canonical) // 24)), "big")

    def pick(n: int) -> int:
        nonlocal bits
        bits, r = divmod(bits, n)
        return r

    if kind == "ip" and ":" in canonical:  # the range kept for documentation
        return ipaddress.IPv6Address((0x20010DB8 << 96) + pick(1 << 96)).compressed
    if kind == "ip":
        return ".".join(str(1 + pick(223 if n == 0 else 254)) for n in range(4))
    if kind == "email":
        local, _, domain = canonical.partition("@")
        letters = "abcdefghijklmnopqrstuvwxyz"
        new = "".join(letters[pick(26)] if c.isalpha() else str(pick(10)) if c.isdigit() else c for c in local)
        host = "".join(letters[pick(26)] for _ in range(3 + attempt // 4 + min(5, len(domain.split(".")[0]))))
        return f"{new}@{host}.example.{('com', 'net', 'org')[pick(3)]}"
    if kind in ("given", "family"):
        script, gender, word = canonical.split(":", 2)
        size = max(2, min(4, len(word) // 2)) + attempt // 4
        name = "".join(SYLLABLES[script][pick(len(SYLLABLES[script]))] for _ in range(size)) + ENDINGS[script][gender]
        return f"{script}:{gender}:{name}"
    if kind == "iban":
        return canonical[:2] + "".join(chr(65 + pick(26)) if c.isalpha() else str(pick(10)) for c in canonical[2:])
    keep = 0 if kind != "phone" or not canonical.startswith("+") else min(3, max(2, len(canonical) - 10))  # the country
    new = canonical[:keep] + "".join(str(pick(10)) for _ in canonical[keep:])
    if kind == "card":
        valid = _luhn(canonical)
        body = new[:-1]
        right = next(str(d) for d in range(10) if _luhn(body + str(d)))
        new = body + (right if valid else str((int(right) + 1 + pick(9)) % 10))
    return new


def render(kind: str, raw: str, surrogate: str) -> str:
    """The surrogate as this mention is written."""
    if kind == "email":
        return surrogate.upper() if raw.isupper() else surrogate
    if kind in ("given", "family"):
        name = surrogate.split(":", 2)[2]
        return name.upper() if raw.isupper() and len(raw) > 1 else name[:1].upper() + name[1:]
    if kind == "ip":
        return surrogate
    letters = iter(surrogate)
    return "".join(next(letters) if c.isalnum() or c == "+" else c for c in raw)


def assign(entities: DataFrame, key: bytes, draws: Callable[[str, str, bytes, int], str] = draw) -> DataFrame:
    """kind, canonical and surrogate of distinct entities: no two share one, and none is an entity itself.

    Each round draws for those without a surrogate; of several that drew the same, the first by canonical form has it. A
    key for each round keeps the result independent of partitions. Draws get longer, so rounds end.
    """

    def drawn(attempt: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                kinds, forms = batch.column("kind").to_pylist(), batch.column("canonical").to_pylist()
                new = [draws(k, c, key, attempt) for k, c in zip(kinds, forms, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("kind"), batch.column("canonical"), pa.array(new, pa.string())], ["kind", "canonical", "surrogate"])

        return run

    entities = staged(entities, "entities")
    taken = entities.select("kind", F.col("canonical").alias("surrogate"))
    left, done, attempt = entities, None, 0
    while True:
        tried = staged(left.select("kind", "canonical").mapInArrow(drawn(attempt), "kind string, canonical string, surrogate string"), "draws")
        free = tried.join(taken, ["kind", "surrogate"], "left_anti")
        won = staged(free.groupBy("kind", "surrogate").agg(F.min("canonical").alias("canonical")), "surrogates")
        done = won if done is None else done.unionByName(won)
        taken = taken.unionByName(won.select("kind", "surrogate"))
        left = tried.join(won, ["kind", "canonical"], "left_anti")
        if left.limit(1).count() == 0:
            return done.select("kind", "canonical", "surrogate")
        attempt += 1


def replace(docs: DataFrame, key: bytes) -> DataFrame:
    """doc_id, text, n_entities and spans (kind:start:end of the new text, comma-joined) of every row of ``docs`` (doc_id, text).

    The same ``key`` gives the same draws. NULL and empty texts have no entities and give an empty text. Repeated rows
    are replaced alike; other columns are ignored.
    """
    read = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    spans_type = "array<struct<start:int,stop:int,kind:string,canonical:string>>"

    def found(wanted: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                spans = [detect(t) for t in batch.column("text").to_pylist()]
                has = [bool(s) == wanted for s in spans]
                part = batch.select(["doc_id", "text"]).filter(pa.array(has, pa.bool_()))
                rows = [[{"start": a, "stop": b, "kind": k, "canonical": c} for a, b, k, c in s] for s, h in zip(spans, has, strict=True) if h]
                names = ["doc_id", "text"] + ["spans"] * wanted
                columns = [*part.columns] + [pa.array(rows, pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("kind", pa.string()), ("canonical", pa.string())])))] * wanted
                yield pa.RecordBatch.from_arrays(columns, names)

        return run

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, counts, marks = [], [], []
            for text, spans, pairs in zip(*(batch.column(c).to_pylist() for c in ("text", "spans", "surrogates")), strict=True):
                known = {(p["kind"], p["canonical"]): p["surrogate"] for p in pairs}
                out, at, size, new = [], 0, 0, []
                for s in spans:
                    value = render(s["kind"], text[s["start"] : s["stop"]], known[s["kind"], s["canonical"]])
                    before = text[at : s["start"]]
                    new.append(f"{s['kind']}:{size + len(before)}:{size + len(before) + len(value)}")
                    out += [before, value]
                    size += len(before) + len(value)
                    at = s["stop"]
                texts.append("".join([*out, text[at:]]))
                counts.append(len(spans))
                marks.append(",".join(new))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string()), pa.array(counts, pa.int64()), pa.array(marks, pa.string())], ["doc_id", "text", "n_entities", "spans"])

    # Only documents with entities wait for the corpus; the others pass.
    hits = staged(read.mapInArrow(found(True), f"doc_id {kind}, text string, spans {spans_type}"), "private")
    hits = hits.withColumn("doc", F.unhex(F.md5(F.concat_ws(" ", F.coalesce(F.col("doc_id").cast("string"), F.lit("?")), "text"))))
    mentions = hits.select("doc", F.explode("spans").alias("s")).select("doc", "s.kind", "s.canonical").distinct()
    table = assign(mentions.select("kind", "canonical").distinct(), key)
    known = mentions.join(table, ["kind", "canonical"]).groupBy("doc").agg(F.collect_list(F.struct("kind", "canonical", "surrogate")).alias("surrogates"))
    replaced = hits.join(known, "doc").select("doc_id", "text", "spans", "surrogates").mapInArrow(written, f"doc_id {kind}, text string, n_entities long, spans string")
    clean = read.mapInArrow(found(False), f"doc_id {kind}, text string").select("doc_id", "text", F.lit(0).cast("long").alias("n_entities"), F.lit("").alias("spans"))
    return clean.unionByName(replaced)
