"""Text cleaning as column expressions: each function is one step, and rules are data.

Steps that need entity tables, Unicode categories or a look at a match's
surroundings are in ``pytext``. All steps take null to null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from siltmill.functions.regex import DIGIT, MYANMAR, NOT_WS, STRIP, WS, WS_BODY, Rule, apply, fold, let, matches, strip, where_found

_COLON = "[:：]"
_LINE = r"[^\n]*"

TAGS = [Rule("<[^>]+>")]

# Words that begin boilerplate, which runs to the end of its line.
NAVIGATION = [Rule(f"(?i){w}{WS}*{_COLON}{WS}*{_LINE}") for w in ("menu", "navigation", "breadcrumb")]
NAVIGATION += [Rule(f"(?i)home{WS}*[>›]{WS}*{_LINE}"), Rule(f"(?i)သင်္ကေတ{WS}*{_COLON}{WS}*{_LINE}"), Rule(f"(?i)မူလစာမျက်နှာ{WS}*[>›]{WS}*{_LINE}")]
ADS = [Rule(f"(?i){w}{WS}*{_COLON}?{_LINE}") for w in ("advertisement", "sponsored", "ads?", "ကြော်ငြာ")]
ADS += [Rule(f"(?i){a}{WS}+{b}{_LINE}") for a, b in (("click", "here"), ("read", "more"), ("continue", "reading"))]
LEGAL = [
    Rule(f"(?i)copyright{WS}*[©℗]?{WS}*{DIGIT}{{4}}{_LINE}"),
    Rule(f"(?i)all{WS}+rights?{WS}+reserved{_LINE}"),
    Rule(f"(?i)disclaimer{WS}*{_COLON}?{_LINE}"),
    Rule(f"(?i)terms?{WS}+of{WS}+use{_LINE}"),
    Rule(f"(?i)privacy{WS}+policy{_LINE}"),
    Rule(f"(?i)မူပိုင်ခွင့်{_LINE}"),
    Rule(f"(?i)တရားဝင်{_LINE}"),
]
# Words of buttons.
BUTTON_WORDS = ("share", "like", "comment", "subscribe", "follow", "tweet", "facebook", "twitter", "download", "print")
BUTTONS = [Rule(rf"(?i)\[?{WS}*{w}{WS}*\]?") for w in BUTTON_WORDS]
BOILERPLATE = NAVIGATION + ADS + LEGAL + BUTTONS
#: A word that every match of the rule with the same place holds.
ANCHORS = ["menu", "navigation", "breadcrumb", "home", "သင်္ကေတ", "မူလစာမျက်နှာ", "advertisement", "sponsored", "ad", "ကြော်ငြာ", "click", "read", "continue"]
ANCHORS += ["copyright", "reserved", "disclaimer", "term", "privacy", "မူပိုင်ခွင့်", "တရားဝင်", *BUTTON_WORDS]

# Marks of text in another encoding, in the order in which they are looked for.
ZAWGYI_MARKS = ("ZG ", "Zawgyi ", "ZAWGYI", "[Zawgyi]", "ZawGyi")

QUOTES = [Rule(r'["\\]', " ")]
DASHES = [Rule("-{2,}", " - ")]
AGENCY_FORMS = (r"\([Xx][Ii][Nn][Hh][Uu][Aa]/[^)]+\)", r"\([Xx][Ii][Nn][Hh][^\n]*?\)", r"\([Xx][Ii][Nn][Hh][Uu][Aa]\)", r"\(ဆင်ဟွာ\)")
AGENCY = [Rule(r"(?m)————[^\n]*$")]
AGENCY += [Rule(rf"{WS}*{p}{WS}*[.။]*{WS}*\z") for p in AGENCY_FORMS]
AGENCY += [Rule(p) for p in AGENCY_FORMS]
AGENCY += [Rule("(?m)^…+")]
# In order: the first that occurs anywhere cuts the text, from the last letter before it.
VERSIONS = [rf"(?is)[^a-zA-Z{MYANMAR}]*\(?{lang}{WS}*{form}\)?.*" for lang in ("english", "chinese") for form in ("vers?i?o?n+", "versi+on+")]
REFERENCES = rf"{WS}*=={WS}*ကိုးကား{WS}*=={WS}*"

# Ranges of pictures, and symbols outside of them. The sixth range takes in most of East Asia's scripts.
PICTURES = r"[\x{1F600}-\x{1F64F}\x{1F300}-\x{1F5FF}\x{1F680}-\x{1F6FF}\x{1F1E0}-\x{1F1FF}\x{2702}-\x{27B0}\x{24C2}-\x{1F251}\x{1F900}-\x{1F9FF}\x{1FA70}-\x{1FAFF}]+"
PICTURES_STRICT = r"[\x{1F600}-\x{1F64F}\x{1F300}-\x{1F5FF}\x{1F680}-\x{1F6FF}\x{1F1E0}-\x{1F1FF}\x{2600}-\x{27BF}\x{1F900}-\x{1F9FF}\x{1FA70}-\x{1FAFF}]+"
SYMBOLS = "[★☆♪♫♬♩♭♮♯♠♣♥♦▲▼◆◇○●□■→←↑↓↔↕※§¶†‡•‰‱℃℉°′″‴]"
SPACING = [
    Rule(r"\n{3,}", "\n\n"),
    Rule(rf"\n{WS}*\n{WS}*\n", "\n\n"),
    Rule(" {3,}", "  "),
    Rule(rf"(?m)^{WS}{{4,}}", "  "),
    Rule(r"(?m)^\t+", "  "),
    Rule(r"[ \t]+", " "),
]
EXPONENTS = [Rule(rf"({DIGIT}+){WS}*\^{WS}*({DIGIT}+)", r"$\1^{\2}$")]
ROOTS = [Rule(r"sqrt\(([^)]+)\)", r"$\\sqrt{\1}$")]
_URL_PARTS = [f"https?://{NOT_WS}+", rf"www\.{NOT_WS}+", f"ftp://{NOT_WS}+", rf"{NOT_WS}+\.[a-z]{{2,}}(?:/{NOT_WS}*)?"]
COUNTING = [Rule(rf"(?i)\[{w}[^\]]*\]") for w in ("IMAGE", "IMG", "PHOTO", "PIC")]
COUNTING += [Rule(f"(?i){p}") for p in _URL_PARTS]
COUNTING += [Rule(r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}"), Rule(f"{WS}+", " "), *STRIP]


def remove_tags(text: Column) -> Column:
    return apply(text, TAGS)


def remove_keywords(text: Column, keywords: Column) -> Column:
    """Every literal keyword, in the array's order; empty and null ones are skipped."""
    return F.when(keywords.isNull(), text).otherwise(F.aggregate(F.filter(keywords, lambda k: F.coalesce(k, F.lit("")) != ""), text, lambda t, k: F.replace(t, k, F.lit(""))))


def cut_zawgyi(text: Column) -> Column:
    """What stands before the first mark of the list that occurs."""

    def cut(t: Column) -> Column:
        out = t
        for mark in reversed(ZAWGYI_MARKS):
            out = F.when(F.contains(t, F.lit(mark)), F.substring(t, F.lit(1), F.instr(t, mark) - 1)).otherwise(out)
        return out

    return let(text, cut)


def remove_agency(text: Column) -> Column:
    """Credits of a news agency, and everything from a foreign version on."""

    def cut(t: Column) -> Column:
        out = t
        for p in reversed(VERSIONS):
            out = F.when(matches(t, p), apply(t, [Rule(p)])).otherwise(out)
        return out

    text = apply(where_found(apply(text, AGENCY[:1]), ["(xinh", "(ဆင်ဟွာ)"], AGENCY[1:-1]), AGENCY[-1:])
    named = lambda t: F.contains(fold(t), F.lit("english")) | F.contains(fold(t), F.lit("chinese"))
    return strip(let(text, lambda t: F.when(named(t), cut(t)).otherwise(t)))


def fold_references(text: Column) -> Column:
    """The first heading of references becomes a plain word, or goes if nothing follows."""

    def fold(t: Column) -> Column:
        whole = rf"(?s)\A(.*?){REFERENCES}(.*)\z"
        after = strip(F.regexp_extract(t, whole, 2))
        before = apply(F.regexp_extract(t, whole, 1), STRIP[1:])
        return F.when(~F.contains(t, F.lit("ကိုးကား")), t).when(~matches(t, REFERENCES), t).when(after == "", before).otherwise(F.concat(before, F.lit(" ကိုးကား "), after))

    return strip(let(text, fold))


def remove_quotes(text: Column) -> Column:
    return apply(text, QUOTES)


def remove_bot_lines(text: Column) -> Column:
    return strip(F.array_join(F.filter(F.split(text, "\n"), lambda x: ~F.contains(F.lower(x), F.lit("botupload"))), "\n"))


def fold_dashes(text: Column) -> Column:
    return strip(apply(text, DASHES))


def remove_pictures(text: Column, strict: bool = False) -> Column:
    """Pictures and symbols. The default range also takes CJK and Hangul; ``strict`` leaves scripts alone."""
    return F.regexp_replace(F.regexp_replace(text, PICTURES_STRICT if strict else PICTURES, ""), SYMBOLS, "")


def normal_spacing(text: Column) -> Column:
    return apply(text, SPACING)


def mark_exponents(text: Column) -> Column:
    return F.regexp_replace(text, rf"({DIGIT}+){WS}*\^{WS}*({DIGIT}+)", r"\$$1^{$2}\$")


def mark_roots(text: Column) -> Column:
    return F.regexp_replace(text, r"sqrt\(([^)]+)\)", r"\$\\sqrt{$1}\$")


def for_comparison(text: Column) -> Column:
    return F.translate(text, " \t\n", "")


def for_counting(text: Column) -> Column:
    """Without image marks, URLs and addresses; null gives an empty string."""
    return apply(F.coalesce(text, F.lit("")), COUNTING)


def count_words(text: Column) -> Column:
    """Words between white space of what ``for_counting`` leaves."""
    return F.size(F.filter(F.split(for_counting(text), " "), lambda w: w != "")).cast("long")


def has_myanmar(text: Column) -> Column:
    return F.coalesce(text.rlike(f"[{MYANMAR}]"), F.lit(False))



#: Characters that count as ordinary in quality checks.
VALID = rf"[{MYANMAR}\p{{L}}\p{{N}}_{WS_BODY}.,!?;:()\"'\-]"


def valid_ratio(text: Column) -> Column:
    """The share of ordinary characters; null for an empty text. The others are taken out and the rest is measured, as matches of a pattern that is counted would all be gathered."""
    return F.length(F.regexp_replace(text, f"[^{VALID[1:]}+", "")) / F.when(F.length(text) > 0, F.length(text))


def _sound(text: Column, least: float, letters: int, myanmar: int, digits: int) -> Column:
    runs = f"[a-zA-Z]{{{letters},}}|[{MYANMAR}]{{{myanmar},}}|[0-9]{{{digits},}}"
    return F.coalesce((F.length(text) > 0) & (valid_ratio(text) >= least) & ~text.rlike(runs), F.lit(False))


def passes_strict(text: Column) -> Column:
    """Few paragraph breaks, four fifths ordinary characters, no very long runs of one kind."""
    return _sound(text, 0.8, 20, 30, 15) & (F.coalesce(F.regexp_count(text, F.lit(rf"\n{WS}*\n")), F.lit(0)) <= 10)


def passes_severe(text: Column) -> Column:
    """Half ordinary characters and no extremely long runs of one kind."""
    return _sound(text, 0.5, 50, 100, 30)


def passes_gate(title: Column, text: Column, script: str | None = MYANMAR, least: int = 1000, stripped: bool = False) -> Column:
    """Title and text, the wanted script in either (None: any), ``least`` code points of text, and ``passes_severe``. Texts may be known to be ``stripped``."""
    if not stripped:
        title, text = strip(F.coalesce(title, F.lit(""))), strip(F.coalesce(text, F.lit("")))
    wanted = F.lit(True) if script is None else title.rlike(f"[{script}]") | text.rlike(f"[{script}]")
    return (title != "") & (text != "") & wanted & (F.length(text) >= least) & passes_severe(text)
