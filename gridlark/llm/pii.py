"""Personal data, with offset-preserving deobfuscation.

Plain identifiers are found in the text as it is. Then transducers rewrite disguises (look-alike and full-width
characters, invisible characters, spelled digits, "at" and "dot") and keep, for every character they put out, the
place of the source that it stands for; identifiers found in the rewritten text go back to spans of the source.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from gridlark.llm.common import ship, words_of

KINDS = ("email", "ip", "card", "phone")

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DIGIT = re.compile(r"[0-9]")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_SEPARATORS = str.maketrans("", "", " ().-+")


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum((0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[int(d)] for d in digits[-2::-2])) % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Every @ with a domain after it and a local part before it, which starts where the last match ended at the earliest."""
    out, end = [], 0
    if "@" not in text:
        return out
    for m in _DOMAIN.finditer(text):
        start = m.start()
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            out.append((start, m.end()))
            end = m.end()
    return out


def base_spans(text: str) -> list[list[tuple[int, int]]]:
    """Spans of the plain identifiers, a list for each of KINDS."""
    found = [emails(text), [], [], []]
    if _DIGIT.search(text):
        found[1] = [m.span() for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split("."))] if "." in text else []
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 13 and 13 <= len(d := m[0].translate(_SEPARATORS)) <= 19 and luhn(d):
                found[2].append(m.span())
        if "+" in text:
            found[3] = [m.span() for m in _PHONE.finditer(text) if 9 <= len(m[0].translate(_SEPARATORS)) <= 15]
    return found


# Look-alikes of ASCII letters and signs.
_ALIKE = dict(zip("аеорсухіјѕԁһкмтвнАЕОРСУХІЈЅКМТВН", "aeopcyxijsdhkmtbhAEOPCYXIJSKMTBH", strict=True))
_ALIKE |= dict(zip("αορνικτΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "aopviktABEZHIKMNOPTYX", strict=True))
_ALIKE |= dict(zip("﹫․。\u00b7‐‑‒–—−﹣", "@...-------", strict=True))
_HIDDEN = frozenset("\u00ad\u200b\u200c\u200d\u200e\u200f\u2060\ufeff")
#: Digit words of a few languages (fixed values).
_SPELLED = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
    "null": "0", "eins": "1", "zwei": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6", "sieben": "7", "acht": "8", "neun": "9",
    "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7", "ocho": "8", "nueve": "9",
}
#: The same with digits for letters that look like them, by rule.
_ALL_SPELLED = _SPELLED | {w.replace(a, b): n for w, n in _SPELLED.items() for a, b in (("o", "0"), ("i", "1"), ("e", "3"), ("s", "5")) if a in w and not w.replace(a, b).isdigit()}
_NUMERAL = r"(?:" + "|".join(sorted(_ALL_SPELLED, key=len, reverse=True)) + r"|[0-9]+)(?![^\W_])"
_RUN = re.compile(rf"(?<!\w)(?:(?:plus|\+)[\x20]?)?(?:{_NUMERAL}(?:[\x20.,()-]{{1,3}}(?:(?:dot|punkt|point|punto)[\x20])?)){{3,}}{_NUMERAL}(?!\w)", re.I)
_WORD = re.compile(r"[^\W_]+|.", re.S)
_AT = re.compile(r"\s{0,3}[\[({<]\s{0,3}(?:at|arroba|@)\s{0,3}[\])}>]\s{0,3}", re.I)
_DOT = re.compile(r"\s{0,3}[\[({<]\s{0,3}(?:dot|punkt|point|punto|\.)\s{0,3}[\])}>]\s{0,3}", re.I)
_BARE = re.compile(r"(?<![\w.%+-])[A-Za-z0-9_%+.-]{1,64}\s{1,3}(?:at|arroba)\s{1,3}[A-Za-z0-9-]{1,63}(?:(?:\s{1,3}(?:dot|punkt|point|punto)\s{1,3}|\.)[A-Za-z0-9-]{1,63})+", re.I)
_BARE_DOT = re.compile(r"(?<=[A-Za-z0-9])\s{1,3}(?:dot|punkt|point|punto)\s{1,3}(?=[A-Za-z0-9])", re.I)
_BARE_AT = re.compile(r"\s{1,3}(?:at|arroba)\s{1,3}", re.I)
_BRACKETED = re.compile(r"[\[({<]\s{0,3}(?:at|arroba|@|dot|punkt|point|punto|\.)\s{0,3}[\])}>]", re.I)
_DOT_WORDS, _AT_WORDS = frozenset((b"dot", b"punkt", b"point", b"punto")), frozenset((b"at", b"arroba"))
_SPELLED_BYTES = frozenset(w.encode() for w in _ALL_SPELLED)
_SPELLED_WORD = re.compile(rf"(?<![^\W_])(?:{'|'.join(_ALL_SPELLED)})(?![^\W_])", re.I)
#: Numerals and spelled ones, as letters: four in a row, two of them spelled.
_FOUR = re.compile(rb"(?=[ds]{4})[ds]*?s[ds]*?s")
#: "at" before a domain name, a sign with spaces around it, an address with spelled dots.
_AT_DOMAIN = re.compile(r"\s(?:at|arroba)\s{1,3}[a-z0-9-]{1,63}(?:\.[a-z]|\s{1,3}(?:dot|punkt|point|punto)\s)", re.I)
_SPACED_AT = re.compile(r"(?<![\w.%+-])[A-Za-z0-9._%+-]{1,64}(\s{0,3}@\s{0,3})[A-Za-z0-9-]{1,63}(?:(?:\.|\s{1,3}\.\s{1,3})[A-Za-z0-9-]{1,63})+")
_SPACED_DOT = re.compile(r"\s{0,3}\.\s{0,3}")
_SPELLED_IP = re.compile(r"(?<![\w.])[0-9]{1,3}(?:\s{1,3}(?:dot|punkt|point|punto)\s{1,3}[0-9]{1,3}){3}(?!\w)", re.I)
# Last labels of domain names; words that stand before an ordinary "at".
_TOPS = frozenset("com org net edu gov mil int info biz io co dev app me tv ai eu de fr es uk us ca au ch at it nl be se no dk fi pl pt br mx ar cl jp cn kr in ru".split())
_NO_NAMES = frozenset(
    "a above again all also an and any are around as available back based be been being below book buy call called check chat code contact daily data day directly down "
    "document documents email file files find found free from get go going have held help her here him home hosted in index info is it join just kept learn left links list listed "
    "listen live located look looked looking me meet more not now off office on once online only or order out over page pages people please posted present published read "
    "register report reports see seen sell shop sign site sites sold source start started starting stay stop store support talk team that the them there these they things this "
    "those time today track up us use used users version via view visit was watch we website were what work worked working works write you".split()
)

#: A text and, for each of its characters, where the source characters it stands for start and end.
Tape = tuple[str, list[int], list[int]]


def _rewrite(tape: Tape, edits: list[tuple[int, int, str]]) -> Tape:
    """With each piece start:end replaced; the new characters stand for the whole piece."""
    text, starts, ends = tape
    out, s, e, at = [], [], [], 0
    for a, b, new in edits:
        out += [text[at:a], new]
        s += starts[at:a] + [starts[a]] * len(new)
        e += ends[at:a] + [ends[b - 1]] * len(new)
        at = b
    out.append(text[at:])
    return "".join(out), s + starts[at:], e + ends[at:]


def _plain(c: str) -> str | None:
    """What a disguised character stands for; None if it stands for itself."""
    if c in _HIDDEN:
        return ""
    if c in _ALIKE:
        return _ALIKE[c]
    if 0xFF01 <= ord(c) <= 0xFF5E:
        return chr(ord(c) - 0xFEE0)
    if c > "ÿ":
        digit = unicodedata.digit(c, None)
        return None if digit is None else str(digit)
    return None


_FOREIGN = re.compile("[\u00ad\u00b7Ͱ-\uffff\U00010000-\U0010ffff]")


def _characters(tape: Tape) -> Tape:
    """Homoglyphs, full-width forms and foreign digits to ASCII; invisible characters go. A letter is taken for a
    look-alike only where it touches ASCII letters, digits or other look-alikes of the same word, so words that are
    wholly Greek or Cyrillic stay."""
    text, edits = tape[0], []
    for m in re.finditer(r"[^\s]*[\u00ad\u00b7Ͱ-\U0010ffff][^\s]*", text):
        word = m[0]
        latin = any(c.isascii() and c.isalnum() or c in "@." or 0xFF01 <= ord(c) <= 0xFF5E or unicodedata.digit(c, None) is not None for c in word)
        for i, c in enumerate(word):
            if not c.isascii() and latin and (new := _plain(c)) is not None:
                edits.append((m.start() + i, m.start() + i + 1, new))
    return _rewrite(tape, edits) if edits else tape


def _spelled(tape: Tape) -> Tape:
    """Runs of four numerals and more become digits if two of them are spelled: spaces and commas go, other separators
    stay, and "dot" and "plus" become signs."""
    edits = []
    for m in _RUN.finditer(tape[0]):
        if len(_SPELLED_WORD.findall(m[0])) < 2:
            continue
        for w in _WORD.finditer(m[0]):
            word = w[0].lower()
            new = _ALL_SPELLED.get(word) or ("." if word in ("dot", "punkt", "point", "punto") else "+" if word == "plus" else "" if word in " ," else word)
            edits.append((m.start() + w.start(), m.start() + w.end(), new))
    return _rewrite(tape, edits) if edits else tape


def _signs(tape: Tape) -> Tape:
    """at and dot in brackets become signs, and bare ones where a name, at and a dotted domain stand together; spelled dots
    among the numbers of an address; and spaces around signs of an address go."""
    for pattern, sign in ((_AT, "@"), (_DOT, ".")):
        if edits := [(*m.span(), sign) for m in pattern.finditer(tape[0])]:
            tape = _rewrite(tape, edits)
    if edits := [(*m.span(), ".") for m in _BARE_DOT.finditer(tape[0]) if "@" in tape[0][max(0, m.start() - 80) : m.start()]]:
        tape = _rewrite(tape, edits)
    edits = []
    for m in _BARE.finditer(tape[0]) if _AT_DOMAIN.search(tape[0]) else ():
        a = _BARE_AT.search(tape[0], m.start())
        dots = [d for d in _BARE_DOT.finditer(tape[0], a.end(), m.end())]
        # an ordinary "at" before a domain name is no disguise
        if dots or m[0].rpartition(".")[2].lower() in _TOPS and tape[0][m.start() : a.start()].lower() not in _NO_NAMES:
            edits += [(*a.span(), "@"), *[(*d.span(), ".") for d in dots]]
    tape = _rewrite(tape, edits) if edits else tape
    if edits := [(*d.span(), ".") for m in _SPELLED_IP.finditer(tape[0]) for d in _BARE_DOT.finditer(tape[0], m.start(), m.end())]:
        tape = _rewrite(tape, edits)
    edits = []
    for m in _SPACED_AT.finditer(tape[0]) if " @" in tape[0] or "@ " in tape[0] or " ." in tape[0] and "@" in tape[0] else ():
        dots = [d for d in _SPACED_DOT.finditer(tape[0], m.end(1), m.end())]
        ends = [*[d.start() for d in dots[1:]], m.end()]
        # up to the last label that ends domain names; what follows belongs to the next sentence
        tops = [i for i, (d, end) in enumerate(zip(dots, ends, strict=True)) if tape[0][d.end() : end].lower() in _TOPS]
        if tops and any(c.isspace() for c in tape[0][m.start(1) : ends[tops[-1]]]):
            edits += [(*m.span(1), "@"), *[(*d.span(), ".") for d in dots[: tops[-1] + 1]]]
    return _rewrite(tape, edits) if edits else tape


def _numeral(word: bytes) -> int:
    return 115 if word in _SPELLED_BYTES else 100 if word.isdigit() or word in _DOT_WORDS or word == b"plus" else 120


def restored(text: str) -> Tape | None:
    """The text without its disguises; None if nothing hints at any."""
    foreign = not text.isascii() and _FOREIGN.search(text) is not None
    words = words_of(text.encode())
    named = not _DOT_WORDS.isdisjoint(words)
    spaced = "@" in text and (" @" in text or "@ " in text or " . " in text)
    signs = named or spaced or _BRACKETED.search(text) is not None or not _AT_WORDS.isdisjoint(words) and _AT_DOMAIN.search(text) is not None
    spelled = bytes(map(_SPELLED_BYTES.__contains__, words)).count(1) > 1 and _FOUR.search(bytes(map(_numeral, words))) is not None
    if not (foreign or signs or spelled):
        return None
    tape: Tape = (text, list(range(len(text))), list(range(1, len(text) + 1)))
    for on, step in ((foreign, _characters), (True, _signs), (True, _spelled)):
        if on:
            tape = step(tape)
    return None if tape[0] == text else tape


def all_spans(text: str) -> tuple[list[list[tuple[int, int]]], list[list[tuple[int, int]]]]:
    """The plain spans and, kind by kind, those with what the restored text adds: spans that no plain one holds. One that
    goes beyond a plain one, as where a look-alike letter begins it, stands beside it."""
    base = base_spans(text)
    if (tape := restored(text)) is None:
        return base, base
    whole = []
    for kind, found in zip(base, base_spans(tape[0]), strict=True):
        mapped = sorted({(tape[1][a], tape[2][b - 1]) for a, b in found})
        new, at = [], 0
        for a, b in mapped:
            while at < len(kind) and kind[at][1] <= a:
                at += 1
            held = at < len(kind) and kind[at][0] <= a and b <= kind[at][1]
            if not held and (not new or new[-1][1] <= a):
                new.append((a, b))
        whole.append(sorted([*kind, *new]))
    return base, whole


def joined(spans: list[list[tuple[int, int]]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind, found in zip(KINDS, spans, strict=True) for a, b in found)


def find_pii(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_disguised.

    The counts and the digest are of plain identifiers; spans has these and those found behind disguises, n_disguised
    their number. Offsets count code points, ends are exclusive. A null text counts as empty and has no spans; an empty
    table gives no rows; repeated rows are scanned each. Columns besides the two that are named are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, rows = batch.column(1), []
            for i in range(len(texts)):
                base, whole = all_spans(texts[i].as_py() or "")
                rows.append((*map(len, base), hashlib.sha256(joined(base).encode()).hexdigest(), joined(whole), sum(map(len, whole)) - sum(map(len, base))))
            columns = list(zip(*rows, strict=True)) if rows else [()] * 7
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()]
            yield pa.record_batch(
                [batch.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]],
                names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_disguised"],
            )

    ship(docs.sparkSession)
    kind = dict(docs.dtypes)[doc_id]
    return docs.selectExpr(f"`{doc_id}` AS doc_id", f"CAST(`{text}` AS STRING) AS text").mapInArrow(
        run, f"doc_id {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_disguised long"
    )
