"""Golden cases of the standardizer and the Unicode keys."""

from weftline.functions.exact import clean, exact_key, leakage_key, leakage_skeleton, letters, standardize

GOLDEN = [
    ("ma-ku-ta-mul", "makutamul", "safe", True), ("k<om>aen", "komaen", "safe", True), ("cinim∅kee", "cinimkee", "safe", True),
    ("lemang(e)da", "lemangeda", "ambiguous", False), ("imatiya/hatini", "imatiya", "ambiguous", False), ("lali:ma", "lali:ma", "unchanged", True),
    ("== tjevus ==", "tjevus", "safe", True), ("mn_gluw", "mngluw", "ambiguous", False), ("Speaker: malu", "Speaker: malu", "unchanged", True),
    ("a ~ b", "a", "ambiguous", False), ("itaial ~ 'taial ~ taial", "itaial", "ambiguous", False), ("{um}ali", "umali", "safe", True),
    ("mha oy~~~ binah", "mha oy binah", "safe", True), ("a~ sawni qaniy ga _~ aw yaqu", "a sawni qaniy ga yaqu", "ambiguous", False),
    ("kalin(-na)-lumah=in", "kalinnalumahin", "ambiguous", False), ("kali(n(na)luma)hin", "kalinnalumahin", "ambiguous", False),
    ("  Speaker: malu  ", "Speaker: malu", "safe", True), ("東壘(turuy)- kn-bong", "東壘turuy knbong", "ambiguous", False),
]


def test_golden_and_idempotent():
    for raw, text, confidence, eligible in GOLDEN:
        out = standardize(raw)
        assert (out["text"], out["status"], out["confidence"], out["eval_eligible"]) == (text, "accepted", confidence, eligible), raw
        assert not standardize(out["text"])["transformations"], raw


def test_not_accepted():
    assert standardize("see http://x.y")["reason"] == "url_in_source_standard"
    assert standardize("a____b")["status"] == "quarantine" and standardize("∅")["status"] == "ineligible"
    assert standardize("x", unclear=True)["reason"] == "contains_unclear" and standardize(None)["status"] == "ineligible"
    assert not standardize("mali", "lexeme")["eval_eligible"] and standardize("lemang(e)da", reviewed=True)["eval_eligible"]


def test_keys():
    assert exact_key(" Straße\n É ") == "strasse é" and leakage_key("ﬁ　A") == "fi a"
    assert letters("A-b 1!") == "ab1" and leakage_skeleton("Ａ-b") == "ab"
    assert clean("a\x00b &amp; é ") == ("a b & é", ["remove_controls", "html_unescape", "unicode_nfc", "whitespace"])
