"""Edge cases of the text functions; every value is invented."""

import pytest

from exposura import rules
from exposura.functions import files, html, lines, sensitive, text, times


@pytest.mark.parametrize("raw, want", [
    ("Opera GX 100", "Opera GX"), ("google chrome v1", "Google Chrome"), ("Chrome Beta 3", "Chrome Beta"),
    ("Lynx", "Lynx"), ("", "Unknown"), ("MICROSOFT EDGE", "Microsoft Edge"),
])
def test_longest_label_wins(one, raw, want):
    assert one(lambda c: text.canonical_label(c, rules.BROWSER_LABELS), raw) == want


def test_first_label_wins(one):
    labels = {"Opera": "Opera", "Opera GX": "Opera GX"}
    assert one(lambda c: text.canonical_label_first(c, labels), "Opera GX") == "Opera"


@pytest.mark.parametrize("raw, want", [
    ("05.03.2024 01:02:03", "2024-03-05T01:02:03"), ("31.02.2024 01:02:03", None), ("2024-03-05", None), ("", None),
])
def test_day_first_timestamp(one, raw, want):
    assert one(times.dmy_timestamp, raw) == want


@pytest.mark.parametrize("raw, want", [
    ("0000-00-00", None), ("0000-00-00 00:00:00", None), ("0", None), ("1/1/0001 12:00:00 AM", None), (" ", None),
    ("2024-01-02 03:04:05", "2024-01-02T03:04:05"), ("2024-01-02", "2024-01-02"), ("a b c", "a b c"),
])
def test_sanitize_date(one, raw, want):
    assert one(times.sanitize_date, raw) == want


@pytest.mark.parametrize("raw, want", [("0", "1970-01-01T00:00:00"), ("soon", None)])
def test_epoch(one, raw, want):
    assert one(times.epoch_timestamp, raw) == want


@pytest.mark.parametrize("raw, want", [
    (" +1 (555) 010-0000 ", "+15550100000"), ("555.0100", "5550100"), ("+", "+"),
])
def test_norm_phone(one, raw, want):
    assert one(text.norm_phone, raw) == want


@pytest.mark.parametrize("raw, want", [
    ("a@example.com", "email"), ("+1 555 010 0000", "phone"), ("example.org", "domain"),
    ("https://example.org", "username"), ("someone", "username"), ("123456", "username"),
])
def test_asset_kind(one, raw, want):
    assert one(text.asset_kind, raw) == want


@pytest.mark.parametrize("raw, want", [
    ("a@example.com", "email"), ("https://example.org/x", "url"), ("sub.example.org", "domain"),
    ("someone", "username"), ("12345", "keyword"), ("two words", "keyword"),
])
def test_asset_kind2(one, raw, want):
    assert one(text.asset_kind2, raw) == want


@pytest.mark.parametrize("raw, want", [
    ("192.0.2.1", True), ("192.0.2.1:80", True), ("[2001:db8::1]", True), ("ssh://x", True), ("example.org", True),
    ("1.2.3", False), ("ab", False), ("word", False),
])
def test_valid_host(one, raw, want):
    assert one(text.is_valid_host, raw) is want


@pytest.mark.parametrize("raw, want", [
    ("HTTP://Example.org/Path/", "http://Example.org/Path"), (" EXAMPLE.org// ", "example.org"),
])
def test_norm_host(one, raw, want):
    assert one(text.norm_host, raw) == want


def test_stacked_schemes(one):
    assert one(text.fix_double_scheme, "https://http://http://example.org") == "https://example.org"


@pytest.mark.parametrize("raw, want", [
    ("https://a.b.example.co.uk:8080/x?y", "example.co.uk"), ("me@mail.example.com", "example.com"),
    ("Example.COM", "example.com"), ("com", ""), ("localhost", ""), ("example.invalid", ""),
])
def test_registered_domain(one, raw, want):
    assert one(lambda c: text.registered_domain(c, ["com", "uk", "co.uk"]), raw) == want


@pytest.mark.parametrize("raw, want", [
    ("My Set [HASH].tar.gz", "my-set"), ("___.csv", "general"), ("a_b--c", "a-b-c"), ("x/y/Z.z", "z"),
])
def test_slug_name(one, raw, want):
    assert one(text.slug_name, raw) == want


def test_slug_index(one):
    assert one(lambda c: text.slug_index(c, "ix-"), "Foo  Bar_b!") == "ix-foo-bar_b"
    assert one(lambda c: text.slug_index(c, "ix-"), "IX-done") == "ix-done"
    assert len(one(lambda c: text.slug_index(c, "ix-"), "a" * 300)) == 100


@pytest.mark.parametrize("raw, want", [("f [hash].txt", "hash"), ("f [NoHash].txt", "nohash"), ("f.txt", "unknown")])
def test_filename_tag(one, raw, want):
    assert one(text.filename_tag, raw) == want


def test_shape_signature(one):
    assert one(text.shape_signature, "ab:cd@ef.gh é") == ":@. "
    assert one(text.shape_signature, "." * 40) == "." * 15


@pytest.mark.parametrize("raw, want", [(" N/A ", None), ("none", None), ("-", None), ("", None), (" x ", "x")])
def test_null_token(one, raw, want):
    assert one(text.null_token, raw) == want


@pytest.mark.parametrize("n, want", [
    (0, "0.0 B"), (1023, "1023.0 B"), (1024, "1.0 KB"), (1280, "1.2 KB"), (92416, "90.2 KB"), (1 << 50, "1.0 PB"),
])
def test_human_bytes(spark, n, want):
    from pyspark.sql import functions as F

    assert spark.range(1).select(text.human_bytes(F.lit(float(n)))).first()[0] == want


KINDS = {
    "": "empty", "NULL": "empty", "$argon2id$v=19$x": "argon2id", "$argon2i$x": "argon2i", "$argon2$x": "argon2",
    "$2y$10$" + "a" * 53: "bcrypt", "$2y$10$" + "a" * 52: "plaintext", "$P$" + "b" * 30: "phpass",
    "$P$" + "b" * 31: "plaintext", "$6$x": "sha512crypt", "$5$x": "sha256crypt", "$1$x": "md5crypt",
    "$pbkdf2-sha256$x": "pbkdf2", "$scrypt$x": "scrypt", "a" * 128: "sha512", "b" * 64: "sha256", "c" * 40: "sha1",
    "d" * 32: "md5", "e" * 64 + ":saltsalt:3_32_2_67108864": "magento_argon2id", "f" * 32 + ":salt:1": "hash_salt",
    "invented": "plaintext",
}


@pytest.mark.parametrize("raw", sorted(KINDS))
def test_secret_kind(one, raw):
    assert one(sensitive.secret_kind, raw) == KINDS[raw]


def test_redact(one):
    raw = "a@example.com, 192.0.2.7, +1 (555) 555-0100, 4111 1111 1111 1111, " + "ab" * 20
    assert one(sensitive.redact, raw) == "[EMAIL], [IP], [PHONE], [CARD], [KEY]"


@pytest.mark.parametrize("raw, want", [
    ("4111111111111111", 1), ("4111 1111 1111 1111", 1), ("4111111111111112", 0), ("41111111111111111111111", 0),
])
def test_card_needs_its_check_digit(one, raw, want):
    assert one(sensitive.card_count, raw) == want


def test_masks(one):
    assert one(sensitive.mask, "abcdefgh") == "a***h"
    assert one(sensitive.mask, "abc") == "***"


def test_keyed_hash_needs_the_pepper(one):
    a = one(lambda c: sensitive.keyed_hash(c, "p"), " A@example.com ")
    assert a == one(lambda c: sensitive.keyed_hash(c, "p"), "a@example.com")
    assert a != one(lambda c: sensitive.keyed_hash(c, "q"), "a@example.com")


@pytest.mark.parametrize("raw, want", [
    ("a@example.com:invented", True), ("someone\tinvented", True), ("prose of quite a few more words here", False),
    ("a:b", False), ("x", False), ("one : two : three", True), ("", False),
])
def test_list_shaped(one, raw, want):
    assert one(sensitive.list_shaped, raw) is want


# --- lines ---------------------------------------------------------------------------

MARKED = "promo\n  ==========  \n\n \nName: x\nkept line\n░▒é漢漢漢漢\n漢漢漢漢\n████\nafter art"


def test_watermark_is_cut(one):
    assert one(lines.strip_watermark, MARKED) == "Name: x\nkept line"


def test_watermark_prefixes_are_kept(one):
    kept = one(lambda c: lines.strip_watermark(c, keep_prefixes=["漢"]), MARKED)
    assert kept == "Name: x\nkept line\n漢漢漢漢"


@pytest.mark.parametrize("raw, want", [
    ("no separator\n█████", "no separator\n█████"), ("a\n==========", ""), ("a\n=========\nb", "a\n=========\nb"),
    ("==========\n====================\nx", "====================\nx"),
])
def test_watermark_edges(one, raw, want):
    assert one(lines.strip_watermark, raw) == want


def test_banner_lines(one):
    raw = "data\n=====\n# note\n// x\n-- y\nJoin t.me/x\nhttps://example.org\nhttps://example.org a\n\n; z"
    assert one(lines.drop_banner_lines, raw) == "data\nhttps://example.org a"


def test_symbol_lines(one):
    assert one(lines.drop_symbol_lines, "a\n=-=-=-=-=-=-\n=-=-=\n") == "a\n=-=-=\n"


def test_keyword_lines(one):
    assert one(lines.drop_keyword_lines, " a \nThe AUTHOR is\n\nb") == "a\nb"


def test_numbered_lines(one):
    assert [tuple(r) for r in one(lines.numbered_lines, "a\n\n# x\nb")] == [(1, "a"), (4, "b")]


# --- files and pages -------------------------------------------------------------------

@pytest.mark.parametrize("path, want", [
    ("a/b.TAR.GZ", "archive"), ("a/b.zip", "archive"), ("a/b.PDF", "binary"), ("b.csv", "structured_table"),
    ("b.jsonl", "json"), ("b.txt", "list"), ("b", "metadata"), ("b.xyz", "metadata"),
])
def test_file_family(one, path, want):
    assert one(files.file_family, path) == want


@pytest.mark.parametrize("path, want", [("a/b.Txt", ".txt"), ("a/.hidden", ""), ("a/b", ""), ("a/b.", ""), ("x.y/z", "")])
def test_extension(one, path, want):
    assert one(files.extension, path) == want


PAGE = (
    '<title>A &amp; B</title><script>var x = "<p>";</script><div class="x post_body y">Hello <b>you</b></div>'
    '<a href="/f?page=2">2</a><a href="/f?page=3">Next &gt;</a><a href="https://example.org/">out</a>'
    '<a href="/f?page=2">again</a>'
)


def test_page_parts(one):
    assert one(lambda c: html.element_text(c, "title"), PAGE) == "A & B"
    assert one(lambda c: html.first_matching_selector(c, rules.BODY_SELECTORS), PAGE) == "Hello you"
    assert one(lambda c: html.next_page_link(c, "page="), PAGE) == "/f?page=3"
    assert one(lambda c, r: html.links(c, r), PAGE, "https://h.example") == [
        "https://h.example/f?page=2", "https://h.example/f?page=3", "https://example.org/",
    ]


def test_last_page_link_without_a_label(one):
    page = '<a href="/p?page=1">1</a> <a href="/p?page=9">9</a>'
    assert one(lambda c: html.next_page_link(c, "page="), page) == "/p?page=9"
    assert one(lambda c: html.next_page_link(c, "page="), "<p>none</p>") is None


def test_entities_are_decoded_once(one):
    assert one(html.strip_html, "<i>&amp;lt;</i><!-- a > b -->") == "&lt;"
