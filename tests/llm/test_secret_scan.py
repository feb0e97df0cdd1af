"""Secrets in plain and wrapped texts."""

import base64
import bz2
import gzip
import lzma
import re
import urllib.parse
import zlib

import zstandard
from pyspark.sql import functions as F

from tierstone.llm import secret_scan as s

PLAIN = 'password=abcdef123 x'


def spans(text):
    return [(s.KINDS[k], a, b) for a, b, k, _ in s.scan_text(text)[0]]


def b64(raw):
    return base64.b64encode(raw).decode()


def by_rule(text):
    out = []
    word = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token"))
    key = "[aA][pP][iI]_?[kK][eE][yY]"
    for m in re.finditer(rf"""({word}|{key})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 6:
            out.append(("assign", m.start(), m.end()))
    out += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out, key=lambda x: (x[1], s.KINDS.index(x[0])))


def test_plain_secrets_as_the_rules_say():
    texts = [
        "", "none", PLAIN, "PassWord : 'short' Api_Key=\"1234567890\"", "token=abc token=abcdef", "AKIA" + "A1" * 8, "AKIA123",
        "ab" * 12, "ab" * 11, "é😀 secret=" + "0f" * 20, "passwordpassword==abcdefg", "toKen=abcdefg", "api-key=abcdefg apikey=abcdefg",
    ]
    for text in texts:
        assert [(s.KINDS[k], a, b) for a, b, k in sorted(s.find_plain(text))] == by_rule(text)
        assert set(by_rule(text)) <= set(spans(text))


def test_layers_map_back_to_the_original():
    raw = PLAIN.encode()
    for wrapped in (gzip.compress(raw), zlib.compress(raw), bz2.compress(raw), lzma.compress(raw), zstandard.compress(raw)):
        token = b64(wrapped)
        assert spans("é " + token + " z") == [("assign", 2, 2 + len(token))]
    assert spans("p\\u0061ssword=abcdef1 x") == [("assign", 0, 21)]
    assert spans("&#112;assword=abcdef1") == [("assign", 0, 21)]
    assert spans(urllib.parse.quote('token: "abcdefgh" .', safe="")) == [("assign", 0, 22)]
    assert spans("%2570assword=abcdef1") == [("assign", 0, 20)]
    twice = b64(("zz " + b64(raw) + " é").encode())
    ((kind, a, b),) = spans("<" + twice + ">")
    assert kind == "assign" and 1 <= a < b <= 1 + len(twice)
    deep = PLAIN
    for _ in range(6):
        deep = b64(gzip.compress(urllib.parse.quote(deep, safe="").encode()))
    assert spans(deep) == [("assign", 0, len(deep))]
    lines = "\n".join(re.findall(".{1,64}", b64(b"x " * 60 + raw)))
    assert [k for k, _, _ in spans(lines)] == ["assign"]


def test_what_unpacks_to_itself_ends(monkeypatch):
    monkeypatch.setattr(s, "_inflated", lambda raw: (raw, False))
    assert s.scan_text("A" * 40)[0] == []
    ring = {b"one!" * 6: b"two!" * 6, b"two!" * 6: b"one!" * 6}
    monkeypatch.setattr(s, "_inflated", lambda raw: (ring.get(raw), False))
    assert s.scan_text(b64(b"one!" * 6))[0] == []


def test_clean_texts_have_no_findings():
    assert spans("Plain words, 100% fine, \\u and &# and %zz and thisisaverylongwordindeed/andmore") == []


def test_bound_on_inflation_is_reported(monkeypatch):
    monkeypatch.setattr(s, "INFLATED", 1000)
    found, _, cut = s.scan_text(b64(gzip.compress(PLAIN.encode() + b" " * 100_000)))
    assert cut == 1 and len(found) == 1


def test_columns(spark):
    rows = [(1, PLAIN), (2, None), (3, ""), (4, "x" * 300_000 + " " + PLAIN), (None, PLAIN), (1, PLAIN)]
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, findings int")
    got = docs.select("doc_id", s.secrets_in(F.col("text")).alias("r"), s.without_secrets(F.col("text")).alias("t")).collect()
    assert [len(r.r.findings) for r in got] == [1, 0, 0, 1, 1, 1]
    assert [r.t for r in got[:3]] == ["[SECRET] x", None, ""] and got[3].t.endswith("x [SECRET] x")
    assert docs.limit(0).select(s.secrets_in(F.col("text"))).collect() == []


def test_joined_members_are_all_read():
    pad = b"nothing here " * 9
    for pack in (gzip.compress, zlib.compress, bz2.compress, lzma.compress, zstandard.compress):
        for joined in (pack(pad) + pack(PLAIN.encode()), pack(pad) + pack(pad) + pack(PLAIN.encode()), pack(pad) + PLAIN.encode()):
            token = b64(joined)
            assert spans(f"é {token} z") == [("assign", 2, 2 + len(token))]
    twice = b64(gzip.compress(bz2.compress(pad) + bz2.compress(PLAIN.encode())))
    assert [k for k, _, _ in spans(twice)] == ["assign"]


def test_what_lies_behind_the_bound_is_read_in_pieces(monkeypatch):
    monkeypatch.setattr(s, "INFLATED", 1000)
    for before in (b" " * 100_000, "é".encode() * 5001, b"x" + "漢".encode() * 5000, b" " * 990):
        found, _, cut = s.scan_text(b64(gzip.compress(before + b" " + PLAIN.encode())))
        assert cut == 1 and len(found) == 1
    found, _, cut = s.scan_text(b64(gzip.compress(zstandard.compress(bytes(range(256)) * 40 + PLAIN.encode()))))
    assert cut == 1 and len(found) == 1


def test_data_that_is_no_utf8_is_read():
    for raw in (PLAIN.encode("utf-16"), PLAIN.encode("utf-16-le"), PLAIN.encode("utf-16-be"), b"\xff\xfe\x80\x01 " + PLAIN.encode() + b" \x9f\x00\x01"):
        token = b64(raw)
        ((kind, a, b),) = spans(f"<{token}>")
        assert kind == "assign" and 1 <= a < b <= 1 + len(token)
        assert spans(b64(gzip.compress(raw))) == [("assign", 0, len(b64(gzip.compress(raw))))]
    late = b"\x01" * 5000 + PLAIN.encode()
    assert [k for k, _, _ in spans(b64(late))] == ["assign"]


def test_lines_of_base64_that_do_not_join():
    line = base64.b64encode(PLAIN.encode() + b"x" * (48 - len(PLAIN))).decode()
    assert len(line) == 64
    for text in (line + "\nHello", line + "\nHello there", line + "\n" + "A" * 13):
        assert [k for k, _, _ in spans(text)] == ["assign"]
    odd = b64(PLAIN.encode() + b"x" * (47 - len(PLAIN))).rstrip("=")
    other = b64(b"token=ghijkl999 " + b"y" * 31).rstrip("=")
    assert len({a for _, a, _ in spans(odd + "\n" + other)}) == 2


def test_other_unicode_escapes():
    plain = "password=hunter22x"
    forms = (
        "".join(f"%u{ord(c):04x}" for c in plain), "".join(f"\\U{ord(c):08X}" for c in plain),
        "".join((f"%u{ord(c):04X}", f"\\u{ord(c):04x}")[i % 2] for i, c in enumerate(plain)),
        "".join(f"%25u{ord(c):04x}" for c in plain),
    )
    for wrapped in forms:
        assert spans("see " + wrapped + " there") == [("assign", 4, 4 + len(wrapped))]
    for odd in ("\\UFFFFFFFF", "%uD800", "\\U0000D800", "%u12", "\\U0041"):
        assert spans(odd) == []
