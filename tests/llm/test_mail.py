import base64
import quopri

import pytest

from faultweave.llm import mail

HEAD = "From: A <a@b.example>\nSubject: =?utf-8?B?w4ljaGVsbGU=?=\n =?utf-8?Q?_verte?=\nTo: c@d.example,\n\te@f.example\n"


def message(body, *, kind="text/plain; charset=utf-8", encoding="8bit"):
    return f"{HEAD}Content-Type: {kind}\nContent-Transfer-Encoding: {encoding}\n\n{body}"


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("charset", ["utf-8", "latin-1", "cp1252"])
def test_round_trip(end, charset):
    text = "Wir öffneten die Brücke über den Fluß.\n\nZweiter Absatz — lang " + "wort " * 40 if charset != "latin-1" else "Déjà vu: größer"
    raw = text.encode(charset)
    for encoding, body in (("base64", base64.encodebytes(raw).decode()), ("quoted-printable", quopri.encodestring(raw).decode()), ("BASE64", base64.b64encode(raw).decode())):
        got = mail.parts_of(message(body, encoding=encoding, kind=f'text/plain; charset="{charset}"').replace("\n", end))[1]
        assert [p.text.strip() for p in got] == [text.strip()]


def test_header_words_and_folding():
    assert "Subject: Échelle verte" in mail.visible_text(message("x")) and "c@d.example, e@f.example" in mail.visible_text(message("x"))


def test_wrong_charset_is_read():
    body = quopri.encodestring("garçon".encode("cp1252")).decode()
    assert "garçon" in mail.visible_text(message(body, encoding="quoted-printable"))


def test_multipart_truncated_and_nested():
    inner = '--i\nContent-Type: text/plain\n\nplain words\n--i\nContent-Type: text/html\n\n<p>html <b>wo</b>rds &amp; &#233;t&eacute;<br>next</p><style>no{}</style>\n--i--'
    body = (
        'pre\n--o\nContent-Type: multipart/alternative; boundary="i"\n\n' + inner + "\n--o\nContent-Type: text/csv\nContent-Disposition: attachment; filename=x\nContent-Transfer-Encoding: base64\n\n"
        + base64.b64encode(b"csv;cell").decode() + "\n--o\nContent-Type: image/png\nContent-Transfer-Encoding: base64\n\nAAAA\n--o\nContent-Type: text/plain\nContent-Transfer-Encoding: base64\n\n"
        + base64.b64encode(b"cut off here").decode()[:-3]
    )
    seen = mail.visible_text(message(body, kind="multipart/mixed; boundary=o"))
    for x in ("plain words", "html words & été\nnext", "csv;cell", "cut off"):
        assert x in seen
    assert "no{}" not in seen and "AAAA" not in seen
    own = mail.body_of(message(body, kind="multipart/mixed; boundary=o"))
    assert "plain words" in own and "cut off" in own and "html" not in own and "csv" not in own


@pytest.mark.parametrize("text", ["", "\n\n", "no header at all", "Subject: only a header", "Content-Type: multipart/mixed; boundary=x\n\nnothing", "Content-Type: multipart/mixed\n\nx", "a: b\nContent-Transfer-Encoding: base64\n\n====", ": \n\n", "\x00�"])
def test_malformed_never_raises(text):
    mail.visible_text(text)
    mail.body_of(text)


def test_deep_nesting_ends():
    text = "Content-Type: message/rfc822\n\n" * 200 + "end"
    mail.visible_text(text)


def test_own_text():
    body = (
        "Hello Jo,\n\nFirst of mine.\nSecond line.\n\nOn Mon, 01 Jun 2026 14:24:38 +0000, Ann Lee wrote:\n> quoted\n> > deeper\n\nBetween.\n\n-----Original Message-----\nFrom: Bo\nSent: x\n\nold text\n\nold more\n\n\nAfter it.\n\n"
        "********************\nThis note is meant only for the people it was sent to.\n\n-- \nJo\nDesk | 5\n\nLe lundi, Bo a écrit :\n> vieux"
    )
    note = "This note is meant only for the people it was sent to."  # known as boilerplate only from other messages
    assert mail.own_text(body) == "First of mine.\nSecond line.\n\nBetween.\n\nAfter it.\n\n" + note
    assert mail.own_text("Hola Ana,\n\n> todo\n") == ""
    assert mail.own_text("Dear all!\nWe met.\n\nBest regards,") == "We met."
    assert mail.own_text("Come soon!") == "Come soon!" and mail.own_text("We sold the 3 red lanterns, but\nkept one,") == "We sold the 3 red lanterns, but\nkept one,"
    assert mail.own_text("jardÃ­n extraÃ±o") == "jardín extraño"


def test_multipart_that_cannot_be_split():
    deep = "innermost words"
    for i in range(25):
        deep = f'--b{i}\nContent-Type: {f"multipart/mixed; boundary=b{i - 1}" if i else "text/plain"}\n\n{deep}\n--b{i}--'
    for kind, body in (("multipart/mixed", "--x\n\nlost words\n--x--"), ('multipart/mixed; boundary="never"', "\nlost words\n"), ("multipart/mixed; boundary=b24", deep)):
        for words in ("lost words", "innermost words"):
            assert (words in mail.visible_text(message(body, kind=kind))) == (words in body)
            assert any(words in p.text for p in mail.parts_of(message(body, kind=kind))[1]) == (words in body)
    assert "lost words" not in mail.visible_text(message("pre\n--x\n\nshown\n--x--\nlost words", kind="multipart/mixed; boundary=x"))
