import pytest

from quire.functions import fold
from quire.functions import text as X


@pytest.mark.parametrize(("given", "wanted"), [(None, ""), ("a\n b\t\tc  d", "a b c d"), (" a b ", "a b"), ("", "")])
def test_flat(one, given, wanted):
    assert one(X.flat, given) == wanted


@pytest.mark.parametrize(("given", "wanted"), [("un deux trois quatre", 4), ("こんにちはです", 7), ("ab cd 漢字", 4), ("", 0), (None, 0), ("a b", 2)])
def test_word_count(one, given, wanted):
    assert one(X.word_count, given) == wanted


@pytest.mark.parametrize(("given", "wanted"), [("automne (m)", "m"), ("gens (m pl) ", "m pl"), ("maison", ""), ("(f) maison", ""), (None, None)])
def test_gender(one, given, wanted):
    assert one(X.gender_of, given) == wanted


@pytest.mark.parametrize(
    ("given", "wanted"),
    [
        ("<!-- note -->\n\n# Titel eins\n", "Titel eins"),
        ("<!-- only a comment -->", ""),
        ("<!-- a\nb\nc --> trailing\n## Two", "Two"),
        ("14\n\n   \n## H", "H"),
        ("Arbeit&nbsp;&nbsp; 7 Tage", "Arbeit 7 Tage"),
        ("Seite 12\nWort", "Wort"),
        ("**Fett** [Link] | x", "Fett Link x"),
        ("x" * 89 + " yz", "x" * 89),
        (None, ""),
        ("", ""),
    ],
)
def test_page_title(one, given, wanted):
    assert one(X.page_title, given) == wanted


def test_lists(one):
    assert one(X.list_items, "[cover, toc ,, x]") == ["cover", "toc", "x"]
    assert one(X.list_items, None) is None
    assert one(X.strip_brackets, " [lesson, grammar-box] ") == "lesson, grammar-box"
    assert one(X.strip_brackets, "lesson") == "lesson"
    assert one(X.tag_tokens, "[grammar-box, Übung_2]") == ["grammar-box", "Übung_2"]


def test_small_functions(one):
    assert one(X.page_key, " page-007 ") == "7"
    assert one(X.page_key, "000") == ""
    assert one(X.unquote, '"A" b"') == 'A" b'
    assert one(X.bare_letter, "d.") and not one(X.bare_letter, "e") and not one(X.bare_letter, None)
    assert one(X.slug_like, "module-3-de-jour") and not one(X.slug_like, "a-b-c")
    assert one(X.control_character, "a\x07b") and not one(X.control_character, "ab")
    assert one(X.non_ascii, "hören") and not one(X.non_ascii, "hoeren")
    assert one(X.cell_for_tsv, "a\t\r\nb") == "a b"
    assert one(X.yaml_string, 'a"b\\') == '"a\\"b\\\\"'
    assert one(X.trimmed_code, "a  \r\nb\t\n") == "a\nb\n"
    assert one(X.capitalised, "éTÉ ICI") == "Été ici"
    assert one(X.title_cased, "l'eau vive 2nd") == "L'Eau Vive 2Nd"
    assert one(X.path_stem, "a/b/c-d.x.pdf") == "c-d.x"
    assert one(X.masked_date, "x\n> Generated 2026-01-02. y") == "x\n> Generated <date>. y"
    assert one(X.clock, 125.9, types="double") == "02:05"
    assert one(lambda c: X.half_even(c), 12.5, types="double") == 12
    assert one(X.half_up, 12.5, types="double") == 13
    assert one(X.percent, 1, 8, types="int") == 12
    assert one(X.percent, 0, 0, types="int") == 0
    assert one(X.visible_text, "<p>a<b>b</b></p><script>x</script> c") == "a b c"
    assert one(X.nfc, "é x") == "é x" and one(X.nfc, "plain") == "plain" and one(X.nfc, None) is None
    assert one(lambda c: X.backoff(1000, 2, c), 3, types="int") == 4000


def test_frontmatter(one):
    page = "---\na: 1\nb: x: y\na: 2\nno colon\nlevel:\n---\n\n body \n"
    assert one(X.frontmatter, page) == {"a": "2", "b": "x: y", "level": ""}
    assert one(X.body, page) == "body"
    assert one(X.frontmatter, "no fences") == {}
    assert one(X.body, "no fences ") == "no fences"
    assert one(X.loose_frontmatter, "---\nqa: pass\n---trailing") == {"qa": "pass"}


def test_folding(one):
    assert one(fold.loose, "Ｇroße Élève-3!") == "grosseeleve3"
    assert one(fold.loose, "é") == "e"
    assert one(fold.fold_case, "STRASSE") == one(fold.fold_case, "Straße")
