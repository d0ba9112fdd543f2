"""Raw e-mail messages as their readers see them, and the part that the sender wrote.

Plain functions over one text, used inside Arrow batches. They never raise: malformed headers, boundaries, encodings and
charsets are read as far as they go.
"""

from __future__ import annotations

import binascii
import html
import re
from typing import NamedTuple


class Part(NamedTuple):
    kind: str  # plain, html, other
    attached: bool
    text: str


_FOLD = re.compile(r"\n[ \t]+")
_HEADER = re.compile(r"[!-9;-~]+:")
_FIELD = re.compile(r"^(content-type|content-disposition|content-transfer-encoding)[ \t]*:(.*)$", re.I | re.M)
_BOUNDARY = re.compile(r"""boundary\s*=\s*(?:"([^"]+)"|([^\s;]+))""", re.I)
_CHARSET = re.compile(r"""charset\s*=\s*["']?([^\s;"']+)""", re.I)
_WORD = re.compile(r"=\?([^?\s]+)\?([bBqQ])\?([^?]*)\?=")
_WORD_GAP = re.compile(r"(=\?[^?\s]+\?[bBqQ]\?[^?]*\?=)\s+(?==\?[^?\s]+\?[bBqQ]\?)")
_NOT_BASE64 = re.compile(r"[^A-Za-z0-9+/]+")
_UNSEEN = re.compile(r"<(style|script|title)\b[^>]*>.*?</\1\s*>|<!--.*?-->", re.I | re.S)
_INLINE = re.compile(r"</?(?:b|i|u|em|strong|span|font|a|small|big|sub|sup|tt|code|mark|s)(?:\s[^<>]*)?/?>", re.I)
_BREAK = re.compile(r"<br\b[^<>]*>\n?|\n?<(?:p|div|li|tr|ul|ol|table|blockquote|h[1-6])\b[^<>]*>", re.I)
_BLOCK_END = re.compile(r"</(?:p|div|ul|ol|table|blockquote|h[1-6])\s*>", re.I)
_TAG = re.compile(r"</?[a-zA-Z!][^<>]*>")


def split_message(text: str) -> tuple[str, str]:
    """Headers (unfolded) and body. A text whose first line is no header is all body."""
    if "\r" in text:
        text = text.replace("\r\n", "\n").replace("\r", "\n")
    text = text.removeprefix(chr(0xFEFF))
    if text.startswith("\n"):
        return "", text[1:]
    if not _HEADER.match(text):
        return "", text
    head, _, body = text.partition("\n\n")
    return _FOLD.sub(" ", head), body


def _fields(head: str) -> dict[str, str]:
    return {m.group(1).lower(): m.group(2).strip() for m in _FIELD.finditer(head)}


def _charset(data: bytes, name: str) -> str:
    """UTF-8 wherever the bytes allow it, whatever was declared; then the declared charset, then Windows' Western one."""
    for charset in ("utf-8", name, "cp1252"):
        try:
            return data.decode(charset)
        except (UnicodeDecodeError, LookupError):
            continue
    return data.decode("latin-1")


def _transfer(body: str, encoding: str, charset: str) -> str:
    encoding = encoding.lower()
    if encoding.startswith("base64"):
        packed = _NOT_BASE64.sub("", body.split("=\n\n", 1)[0] if "=" in body else body)
        packed = packed[: len(packed) - (len(packed) % 4 == 1)]
        try:
            return _charset(binascii.a2b_base64(packed + "=" * (-len(packed) % 4)), charset)
        except binascii.Error:
            return body
    if encoding.startswith("quoted-printable"):
        return _charset(binascii.a2b_qp(body.encode("utf-8", "replace")), charset)
    return body


def html_text(markup: str) -> str:
    """The visible text of HTML: paragraphs and breaks end lines, other tags vanish, entities are undone."""
    text = _UNSEEN.sub("", markup)
    text = _INLINE.sub("", text)
    text = _BLOCK_END.sub("\n\n", _BREAK.sub("\n", text))
    return html.unescape(_TAG.sub(" ", text)).replace("\xa0", " ")


def _plain(fields: dict[str, str], body: str, attached: bool, attachments: bool) -> list[Part]:
    return [] if attached and not attachments else [Part("plain", attached, _transfer(body, fields.get("content-transfer-encoding", ""), "utf-8"))]


def _read(fields: dict[str, str], body: str, depth: int, attachments: bool) -> list[Part]:
    """The text parts of a body. A multipart that cannot be split (no boundary, one that begins no part, nested too deep) and a
    message nested too deep are read as one plain text."""
    kind = fields.get("content-type", "text/plain").strip().lower() or "text/plain"
    attached = fields.get("content-disposition", "").lower().startswith("attachment")
    if kind.startswith("multipart/") and depth < 20 and (m := _BOUNDARY.search(fields.get("content-type", ""))):
        mark = "--" + (m.group(1) or m.group(2))
        pieces = ("\n" + body).split("\n" + mark)
        if len(pieces) == 1 or pieces[1].startswith("--"):
            return _plain(fields, body, attached, attachments)
        parts: list[Part] = []
        for piece in pieces[1:]:
            if piece.startswith("--"):
                break
            first, _, rest = piece.partition("\n")
            head, inner = ("", rest[1:]) if rest.startswith("\n") else ((h := rest.partition("\n\n"))[0], h[2])
            if head and not _HEADER.match(head):
                head, inner = "", rest
            parts += _read(_fields(_FOLD.sub(" ", head)), inner, depth + 1, attachments)
        return parts
    if kind.startswith("message/") and depth < 20:
        head, inner = split_message(_transfer(body, fields.get("content-transfer-encoding", ""), "utf-8"))
        return [Part("plain", attached, read_header(head)), *_read(_fields(head), inner, depth + 1, attachments)]
    if kind.startswith(("multipart/", "message/")):
        return _plain(fields, body, attached, attachments)
    if not kind.startswith("text/") or attached and not attachments:
        return []
    charset = m.group(1) if (m := _CHARSET.search(fields.get("content-type", ""))) else "utf-8"
    text = _transfer(body, fields.get("content-transfer-encoding", ""), charset)
    is_html = kind.startswith("text/html")
    return [Part("html" if is_html else "plain" if kind.startswith("text/plain") else "other", attached, html_text(text) if is_html else text)]


def _decode_word(m: re.Match) -> str:
    charset, how, data = m.groups()
    try:
        raw = binascii.a2b_base64(data + "=" * (-len(data) % 4)) if how in "bB" else binascii.a2b_qp(data.encode("ascii", "replace"), header=True)
    except binascii.Error:
        return m.group(0)
    return _charset(raw, charset)


def read_header(head: str) -> str:
    """Header lines, unfolded, with encoded words undone."""
    return _WORD.sub(_decode_word, _WORD_GAP.sub(r"\1", head)) if "=?" in head else head


def parts_of(text: str, attachments: bool = True) -> tuple[str, list[Part]]:
    """The readable header and the text parts, decoded."""
    head, body = split_message(text)
    return read_header(head), _read(_fields(head), body, 0, attachments)


def visible_text(text: str) -> str:
    """All that a reader sees: headers, every text part, quoted mail and text attachments."""
    head, parts = parts_of(text)
    return "\n\n".join([head, *(p.text for p in parts)])


# How mail programs in the corpus' languages mark a quotation (fixed phrases).
_ATTRIBUTION = re.compile(
    r"^(?:on\b.*\bwrote|le\b.*\ba écrit|el\b.*\bescribió|am\b.*\bschrieb\b.*|.*\bschrieb|.*\bwrote|.*\ba écrit|.*\bescribió)\s*:\s*$", re.I
)
_ORIGINAL = re.compile(r"^-{2,}\s*(?:original message|original-nachricht|ursprüngliche nachricht|message d'origine|message original|mensaje original|forwarded message)\s*-{2,}$", re.I)
_RULE = re.compile(r"^([-_*=~#])\1{7,}$")


def _addressed(line: str, more: bool) -> bool:
    """A salutation or a closing formula by its form: a line of at most four words that ends with a comma (a salutation also with an
    exclamation mark, if more follows)."""
    return line.endswith((",", "!") if more else ",") and len(line) < 60 and len(line.split()) <= 4 and not any(map(str.isdigit, line))


def body_of(text: str) -> str:
    """What the sender wrote, paragraphs apart: no headers, attachments, quoted mail, attribution, salutation or signature.

    Of alternatives the plain text counts, the HTML only where there is none or it is blank. What many messages end with, such
    as disclaimers, is known only from all of them: see ``textquality``.
    """
    head, body = split_message(text)
    parts = [p for p in _read(_fields(head), body, 0, False) if not p.attached]
    chosen = [p for p in parts if p.kind == "plain" and p.text.strip()] or [p for p in parts if p.kind == "html"] or [p for p in parts if p.kind == "other"]
    return own_text("\n".join(p.text for p in chosen))


def _mended(line: str) -> str:
    """A line of UTF-8 that was read in a Western charset, read again."""
    if "Ã" in line or "Â" in line:
        for charset in ("cp1252", "latin-1"):
            try:
                return line.encode(charset).decode("utf-8")
            except UnicodeError:
                continue
    return line


def own_text(body: str) -> str:
    """``body`` without what its sender did not write in it."""
    if "\r" in body:
        body = body.replace("\r\n", "\n").replace("\r", "\n")
    kept: list[str] = []
    lines = [_mended(x.rstrip()) for x in body.split("\n")]
    i, n, original = 0, len(lines), 0
    while i < n:
        line = lines[i]
        bare = line.strip()
        if original:
            # an unmarked quotation ends at two blank lines after its own header lines
            if original == 1 and not bare:
                original = 2
            elif original == 2 and bare:
                original = 3
            elif original == 3 and not bare and (i + 1 >= n or not lines[i + 1].strip()):
                original = 0
            i += 1
            continue
        if _ORIGINAL.match(bare):
            original = 1
        elif line == "--" and (i + 1 >= n or not lines[i + 1].startswith("--")):
            # a signature: up to the next blank line; a disclaimer or a quotation may follow
            while i + 1 < n and lines[i + 1].strip():
                i += 1
        elif bare.startswith(">"):
            pass
        elif bare.endswith(":") and _ATTRIBUTION.match(bare) and i + 1 < n and any(x.lstrip().startswith(">") for x in lines[i + 1 : i + 4]):
            pass
        else:
            kept.append(bare)
        i += 1
    blocks: list[list[str]] = [[]]
    for line in kept:
        if line:
            if not _RULE.match(line):
                blocks[-1].append(line)
        elif blocks[-1]:
            blocks.append([])
    blocks = [b for b in blocks if b]
    if blocks and _addressed(blocks[0][0], True) and (len(blocks) > 1 or len(blocks[0]) > 1 or _addressed(blocks[0][0], False)):
        blocks[0] = blocks[0][1:]
    if blocks and len(blocks[-1]) == 1 and _addressed(blocks[-1][0], False):
        blocks.pop()
    return "\n\n".join("\n".join(b) for b in blocks if b)
