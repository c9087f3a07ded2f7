from __future__ import annotations

import random

import pytest

from runstar.llm import language
from tests.llm.conftest import ODD

LANGUAGES = {"en": "the of and to in is that with for this have from they not".split(),
             "de": "der die und das nicht mit für ist auch werden über eine".split(),
             "fr": "le les et des pour dans être qui sur avec était une".split()}
SCHEMA = "doc_id long, text string, declared string, address string, host string, logs string"


def _text(lang, seed, n=40):
    rng = random.Random(f"{lang}{seed}")
    return " ".join(rng.choice(LANGUAGES[lang]) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    out = []
    for k, lang in enumerate(LANGUAGES):
        out += [(1000 * k + i, _text(lang, i), lang if i % 3 else f"{lang.upper()}-XX", f"https://www.{lang}.example.{lang}/p{i}", "h", "l")
                for i in range(40)]
    return out


def _run(spark, rows):
    return {r.doc_id: r for r in language.identify(spark.createDataFrame(rows, SCHEMA), "doc_id").collect()}


def test_held_out_texts_and_odd_rows(spark, rows):
    held = [(9000 + i, _text(lang, 5000 + i), None, None, "h", "l") for i, lang in enumerate([*LANGUAGES] * 10)]
    wrong = [(9500, _text("de", 1), "en", "https://www.en.example.en/", "h", "l")]
    short = [(9600, "die", "de", "https://www.de.example.de/x", "h", "l"), (9601, "zzq", None, "https://www.de.example.de/y", "h", "l")]
    odd = [(9700 + k, t, None, None, "h", "l") for k, (_, t) in enumerate(ODD)]
    got = _run(spark, rows + held + wrong + short + odd)
    assert all(got[9000 + i].language == lang and got[9000 + i].kept for i, lang in enumerate([*LANGUAGES] * 10))
    assert all(got[r[0]].language == r[2].lower()[:2] for r in rows)
    assert got[9500].language == "de" and got[9600].language == "de" and got[9601].language == "de"
    for k, (_, t) in enumerate(ODD):
        if not any(c.isalpha() for c in t or ""):
            r = got[9700 + k]
            assert not r.kept and r.language is None and r.text_language is None


def test_evidence_by_brute_force(spark, rows):
    """Priors and declarations from plain counts, for a text that tells nothing (all languages alike)."""
    blank = (9999, "12 34", "de", "https://www.fr.example.fr/q", "h", "l")
    got = _run(spark, [*rows, blank])[9999]
    k, n = language.SMOOTH, 40
    overall = (n + 1) / (3 * n + 3)
    suffix = {x: ((n if x == "fr" else 0) + k * overall) / (n + k) for x in LANGUAGES}
    host = {x: ((n if x == "fr" else 0) + k * suffix[x]) / (n + k) for x in LANGUAGES}
    said = {x: ((n if x == "de" else 0) + 1) / (n + 4) for x in LANGUAGES}
    weights = {x: host[x] * (1 - language.NONE) * said[x] for x in LANGUAGES} | {None: language.NONE / 4}
    best = max(weights.values())
    assert got.probability == pytest.approx(best / sum(weights.values())) and not got.kept


def test_noise_is_rejected_and_clean_text_is_not(spark, rows):
    rng = random.Random(3)
    noise = "".join(chr(rng.choice([*range(97, 123)] + [*range(0x400, 0x4FF)])) for _ in range(400))
    got = _run(spark, [*rows, (8000, noise, None, None, "h", "l"), (8001, _text("fr", 77, 3000), "fr", None, "h", "l")])
    assert not got[8000].kept and got[8001].kept


def test_repeated_and_empty(spark, rows):
    got = language.identify(spark.createDataFrame(rows[:50] + rows[:10], SCHEMA), "doc_id")
    assert got.count() == 60
    assert language.identify(spark.createDataFrame([], SCHEMA), "doc_id").count() == 0
    few = language.identify(spark.createDataFrame(rows[:2], SCHEMA), "doc_id").collect()
    assert [r.kept for r in few] == [True, True]


THAI = "สวัสดี ครับ วันนี้ อากาศ ดี มาก เรา ไป ตลาด กัน ไหม ฉัน ชอบ กิน ข้าว ผัด กับ ไข่ และ น้ำ ชา เย็น ที่ บ้าน ของ เพื่อน".split()
RUSSIAN = "и в не на что он как это по но они мы этот который быть мочь человек время год день рука раз дело жизнь глаз слово".split()
CHINESE = "今天 天气 很好 我们 一起 去 公园 散步 吧 他 喜欢 喝茶 看书 也 听 音乐 昨天 晚上 下了 很大 的 雨 所以 路上 都是 水 的 我们".split()


def test_rare_and_undeclared_languages_stay(spark, rows):
    rng = random.Random(8)
    thai = [(3000 + i, " ".join(rng.choice(THAI) for _ in range(50)), None, None, "h", "l") for i in range(30)]
    russian = [(4000 + i, " ".join(rng.choice(RUSSIAN) for _ in range(50)), "ru", None, "h", "l") for i in range(4)]
    single = [(5000, "".join(rng.choice(CHINESE) for _ in range(200)), None, None, "h", "l"),
              (5001, " ".join(rng.choice(THAI) for _ in range(80)), "th", None, "h", "l")]
    got = _run(spark, rows + thai + russian + single)
    assert all(r.kept for r in got.values())
    assert all(got[4000 + i].language == "ru" for i in range(4)) and got[5001].language == "th"
    null = [(r[0], r[1], None, *r[3:]) for r in rows + thai + russian + single]
    assert all(r.kept for r in _run(spark, null).values())


def test_more_languages_than_are_modelled(spark, rows, monkeypatch):
    monkeypatch.setattr(language, "LANGUAGES", 3)
    rng = random.Random(9)
    more = [(6000 + i, " ".join(rng.choice(RUSSIAN) for _ in range(50)), "ru", "https://x.ru/", "h", "l") for i in range(20)]
    got = _run(spark, rows + more)
    assert all(got[r[0]].kept and got[r[0]].language == "ru" for r in more)


def test_noise_by_its_letters_alone():
    rng = random.Random(4)
    for alphabet in ("abcdefghijklmnopqrstuvwxyz", "abcdef0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
                     "".join(map(chr, range(0x4E00, 0x4E00 + 300)))):
        assert language.is_noise("".join(rng.choice(alphabet) for _ in range(1500)))
    for words in (THAI, RUSSIAN, LANGUAGES["en"], LANGUAGES["de"], LANGUAGES["fr"]):
        for n in (15, 40, 400):
            assert not any(language.is_noise(" ".join(rng.choice(words) for _ in range(n))) for _ in range(20))
    assert not language.is_noise("".join(rng.choice(CHINESE) for _ in range(300))) and not language.is_noise("short")


def test_addresses_and_pages(spark):
    rows = [("https://user@Blog.Example.DE:8080/a?b#c", '<HTML class="x" lang="de-AT"><style>p{}</style><p>die &amp; <b>der</b>'),
            ("plain-source", "<p>no lang</p>"), (None, None)]
    pages = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "page_id long, url string, html string")
    got = {r.page_id: r for r in language.page_evidence(pages).select(
        "page_id", "text", language.declared_language(language.F.col("declared")).alias("d"), language.host_of(language.F.col("address")).alias("h")).collect()}
    assert (got[0].d, got[0].h) == ("de", "blog.example.de") and "p{}" not in got[0].text and "die" in got[0].text
    assert (got[1].d, got[1].h) == (None, "plain-source") and got[2].text is None
    hosts = spark.createDataFrame([("a.b.c",), ("src0",)], "h string").select(language.suffix_of(language.F.col("h")).alias("s"))
    assert [r.s for r in hosts.collect()] == ["c", ""]
