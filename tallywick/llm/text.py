"""What a reader sees: text with its encodings, markup and look-alikes undone. Pure functions of one string."""

from __future__ import annotations

import html
import re as plain
import unicodedata

import regex as re

#: Letters of other scripts that look like Latin ones (from the public Unicode confusables data), by Latin letter.
LOOK_ALIKES = {
    "a": "аαɑ", "b": "ьβ", "c": "сϲᴄ", "d": "ԁɗ", "e": "еєε", "f": "ғ", "g": "ɡց", "h": "һհ", "i": "іιıɩ", "j": "јϳ", "k": "кκ", "l": "ӏⅼ", "m": "мⅿ",
    "n": "пηո", "o": "оοօσ", "p": "рρ", "q": "ԛգ", "r": "гᴦ", "s": "ѕꜱ", "t": "тτ", "u": "υսц", "v": "ѵνᴠ", "w": "ѡԝω", "x": "хχ", "y": "уγү", "z": "ᴢ",
}
_FOLD = str.maketrans({x: latin for latin, others in LOOK_ALIKES.items() for x in others})

_TAG = re.compile(r"</?([a-zA-Z][a-zA-Z0-9]*)\b[^<>]*>|<!--.*?-->", re.S)
#: Tags that stand between words; the others may stand within one.
BLOCK_TAGS = frozenset("address article aside blockquote br dd div dl dt fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr li main nav ol p pre section table td th tr ul".split())
_ESCAPE = re.compile(r"\\(?:u([0-9a-fA-F]{4})|x([0-9a-fA-F]{2})|([nrtbf\"/\\]))")
_PERCENT = re.compile(r"(?:%[0-9a-fA-F]{2})+")
_QUOTED = re.compile(r"(?:=[0-9A-F]{2})+|=\r?\n")
#: Escapes of an escape's own sign, one inside the other: as many rounds as levels, if they weren't undone at once.
_NESTED = ((re.compile(r"%(?:25)+(?=[0-9a-fA-F]{2})"), "%"), (re.compile(r"=(?:3D)+(?=[0-9A-F]{2})"), "="), (re.compile(r"&(?:amp;|#0*38;|#[xX]0*26;)+"), "&"))
_BROKEN = re.compile(r"(?<=\p{L})[-\u2010\u2011]\r?\n[\s>|*#]*(?=\p{L})")
_HIDDEN = re.compile(r"[\p{Cf}\p{Cc}\uFE00-\uFE0F--[\n\t\r]]", re.V1)
_MARKS = re.compile(r"\p{Mn}+")
#: The bytes 80 to 9f as Windows-1252 shows them.
_CP1252 = {bytes([b]).decode("cp1252"): b for b in range(0x80, 0xA0) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)} | {chr(b): b for b in range(0x80, 0x100)}
_MOJIBAKE = re.compile("[\u00c2-\u00f4][" + "".join(map(re.escape, sorted(x for x, b in _CP1252.items() if 0x80 <= b <= 0xBF))) + "]+")


def _unmojibake(m: re.Match) -> str:
    try:
        return bytes(_CP1252[x] for x in m.group()).decode("utf-8")
    except (UnicodeDecodeError, KeyError):
        return m.group()


def _unescape(m: re.Match) -> str:
    code = m.group(1) or m.group(2)
    return chr(int(code, 16)) if code else {"n": "\n", "r": "\n", "t": "\t", "b": " ", "f": " "}.get(m.group(3), m.group(3))


def _unpercent(m: re.Match) -> str:
    try:
        return bytes.fromhex(m.group().replace("%", "")).decode("utf-8")
    except UnicodeDecodeError:
        return m.group()


def _unquote(m: re.Match) -> str:
    try:
        return bytes.fromhex(m.group().replace("=", "")).decode("utf-8") if m.group()[1] not in "\r\n" else ""
    except (UnicodeDecodeError, ValueError):
        return m.group()


def decoded(text: str, few: bool = True) -> str:
    """Mojibake, character references, string escapes, percent and quoted-printable bytes, tags and words broken at a line's end, undone, until nothing is left to undo: each step makes the text shorter.

    few: percent and quoted-printable bytes are undone wherever they are valid. Otherwise only in texts with more than two
    of a kind, as in `20=20` or `5%20` the writer may have meant what stands there.
    """
    while True:
        before = text
        for nested, sign in _NESTED:
            if sign in text:
                text = nested.sub(sign, text)
        if not text.isascii() and _MOJIBAKE.search(text):
            text = _MOJIBAKE.sub(_unmojibake, text)
        if "&" in text:
            text = html.unescape(text)
        if "\\" in text and ("\\u" in text or "\\n" in text or "\\x" in text or '\\"' in text):
            text = _ESCAPE.sub(_unescape, text)
            if re.search("[\ud800-\udfff]", text):
                text = text.encode("utf-16", "surrogatepass").decode("utf-16", "replace")
        if "%" in text and (few or len(_PERCENT.findall(text)) > 2):
            text = _PERCENT.sub(_unpercent, text)
        if "=" in text and (few or len(re.findall("=[0-9A-F]{2}", text)) > 2 or "=\n" in text):
            text = _QUOTED.sub(_unquote, text)
        if len(text) >= len(before):
            break
    if "<" in text:
        text = _TAG.sub(lambda m: " " if m.group(1) and m.group(1).lower() in BLOCK_TAGS else "", text)
    return _BROKEN.sub("", _HIDDEN.sub("", text))


#: Stretches between white space, of which most come again and again, are folded once.
_BLANKS = plain.compile(r"(\s+)")
_folds: dict[str, str] = {}
_streams: dict[str, tuple[str, str]] = {}
KEPT = 300_000


def _folded(part: str) -> str:
    found = _folds.get(part)
    if found is None:
        if part.isascii():
            found = part.lower()
        else:
            found = unicodedata.normalize("NFKD", part).casefold()
            found = unicodedata.normalize("NFKC", _MARKS.sub("", found).translate(_FOLD))
        if len(part) <= 40:
            if len(_folds) >= KEPT:
                _folds.clear()
            _folds[part] = found
    return found


def folded(text: str) -> str:
    """decoded text without case, accents, font variants and look-alikes of Latin letters."""
    return "".join(map(_folded, _BLANKS.split(decoded(text))))


_WORD = re.compile(r"[\p{L}\p{N}]+")


def _streamed(part: str) -> tuple[str, str]:
    found = _streams.get(part)
    if found is None:
        words = _WORD.findall(_folded(part))
        found = "".join(words), "".join("1" + "0" * (len(w) - 1) for w in words)
        if len(part) <= 40:
            if len(_streams) >= KEPT:
                _streams.clear()
            _streams[part] = found
    return found


def _flow(clean: str) -> tuple[str, str]:
    parts = [_streamed(p) for p in clean.split()]
    return "".join(p[0] for p in parts), "".join(p[1] for p in parts)


def stream(text: str) -> tuple[str, str]:
    """The letters and digits of the folded text in a row, and for each `1` if something stands between it and the one before, else `0`."""
    return _flow(decoded(text))


def streams(text: str) -> list[tuple[str, str]]:
    """stream, and where the text has but one or two percent or quoted-printable bytes, also the stream with these left as they stand."""
    bold = decoded(text)
    careful = decoded(text, few=False) if "%" in text or "=" in text else bold
    return [_flow(bold)] if careful == bold else [_flow(bold), _flow(careful)]
