"""Column functions of the engine: identifiers, outcome codes, innings, bases, ratios and test statistics."""

from __future__ import annotations

import os
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

SALT = "INFIELD_ID_SALT"  #: environment variable with the salt of canonical ids


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def canonical_id(key: Column | str, salt: str | None = None) -> Column:
    """A 26-character identifier of ``key``: the top 130 bits of SHA-256 in Crockford's base 32. Null for null."""
    digest = F.sha2(F.concat(_col(key), F.lit("|" + (salt if salt is not None else os.environ.get(SALT, "infield")))), 256)
    # 60, 60 and 20 bits at a time, as many as a long holds; of the last ones the top 10 count
    to32 = lambda start, length, digits: F.lpad(F.conv(F.substring(digest, start, length), 16, 32), digits, "0")
    text = F.substring(F.concat(to32(1, 15, 12), to32(16, 15, 12), to32(31, 5, 4)), 1, 26)
    return F.translate(text, "IJKLMNOPQRSTUV", "JKMNPQRSTVWXYZ")


def present(c: Column | str) -> Column:
    """Whether a source id is one: not null, blank or the text of a missing value."""
    c = _col(c)
    return c.isNotNull() & ~F.trim(c).isin("", "None", "nan")


def id_or_hash(canonical: Column | str, entity: str, source: str, source_id: Column | str) -> Column:
    """The bridge's id where there is one, else a derived id; null where the source has none."""
    source_id = _col(source_id).cast("string")
    return F.when(present(source_id), F.coalesce(_col(canonical), canonical_id(F.concat(F.lit(f"{entity}:source:{source}:"), source_id))))


def short_hash(*parts: Column | str, length: int = 20) -> Column:
    """The first characters of the SHA-1 of the parts joined by bars."""
    return F.substring(F.sha1(F.concat_ws("|", *[_col(p).cast("string") for p in parts])), 1, length)


def to_long(c: Column | str) -> Column:
    """Text to integer; blanks, junk and fractions are null."""
    text = F.trim(_col(c).cast("string"))
    return F.when(text.rlike(r"^[+-]?[0-9]+$"), text.try_cast("long"))


def to_double(c: Column | str) -> Column:
    return F.nullif(F.trim(_col(c).cast("string")), F.lit("")).try_cast("double")


def to_long_truncated(c: Column | str) -> Column:
    """Text or number to integer by way of a double, as pinned gold columns take it."""
    return to_double(c).try_cast("long")


def to_text(c: Column | str) -> Column:
    return F.nullif(F.trim(_col(c).cast("string")), F.lit(""))


def first_match(rules: Iterable[tuple[Column, str]], default: str | None) -> Column:
    """The value of the first rule that holds."""
    out = None
    for condition, value in rules:
        out = F.when(condition, value) if out is None else out.when(condition, value)
    return out.otherwise(default)


def ratio(a: Column | str, b: Column | str) -> Column:
    """a / b as a double, null where b is 0."""
    return _col(a).cast("double") / F.nullif(_col(b).cast("double"), F.lit(0.0))


def rounded(c: Column | str, places: int) -> Column:
    """A double rounded half up in units of the last place, as SQL engines on doubles do; a product beyond doubles leaves it as it is.

    Spark rounds the shortest text of a double instead, which lifts a number just below a tie: 0.2580375 to 0.258038.
    """
    unit = F.lit(10.0**places)
    value = _col(c).cast("double")
    out = F.round(value * unit, 0) / unit
    return F.when(F.isnan(out) | (F.abs(out) == float("inf")), value).otherwise(out)


# Outcome codes ------------------------------------------------------------------------------------------

#: Groups of outcome codes.
HITS = ["1B", "2B", "3B", "HR"]
AT_BATS = ["1B", "2B", "3B", "HR", "K", "OUT", "DP", "TP", "FC", "ERROR"]
BASES_OF_HIT = {"1B": 1, "2B": 2, "3B": 3, "HR": 4}
SWINGS = ["swinging_strike", "swinging_strike_blocked", "missed_bunt", "foul", "foul_tip", "foul_bunt", "bunt_foul_tip", "hit_into_play", "hit_into_play_no_out", "hit_into_play_score"]
WHIFFS = ["swinging_strike", "swinging_strike_blocked", "missed_bunt"]
SOURCE_LEAGUE = {"mlb_statsapi": "MLB", "mlb_statcast": "MLB", "retrosheet_local": "MLB", "npb_spaia": "NPB", "kbo_api": "KBO", "kbo_local": "KBO", "lmb_local": "LMB", "indy_local": "INDY"}
BASE_LABELS = {0: "Bases empty", 1: "1st", 2: "2nd", 3: "1st & 2nd", 4: "3rd", 5: "1st & 3rd", 6: "2nd & 3rd", 7: "Loaded"}
FINAL_VALUES, FINAL_PREFIXES = ["Final", "final", "Game Over", "Completed Early", "試合終了"], ["Final:", "Completed Early:"]


def event_code(event: Column | str) -> Column:
    """Outcome code of a pitch-tracking event. The order decides: sacrifices come before the double plays they contain."""
    v = F.upper(_col(event))
    has = lambda *xs: F.greatest(*[v.contains(x) for x in xs], F.lit(False))
    rules = [
        (v.isNull() | (v == ""), "UNKNOWN"),
        (has("STRIKEOUT") | (v == "K"), "K"),
        (has("WALK") | (v == "BB"), "BB"),
        (has("HBP", "HIT_BY_PITCH"), "HBP"),
        (has("HOME_RUN") | (v == "HR"), "HR"),
        (v.isin("SINGLE", "1B"), "1B"),
        (v.isin("DOUBLE", "2B"), "2B"),
        (v.isin("TRIPLE", "3B"), "3B"),
        (v.startswith("SAC_FLY"), "SF"),
        (v.startswith("SAC_BUNT"), "SH"),
        (has("TRIPLE_PLAY"), "TP"),
        (has("DOUBLE_PLAY"), "DP"),
        (has("FIELDERS_CHOICE"), "FC"),
        (has("INTERF"), "INT"),
        (v == "TRUNCATED_PA", "TRUNCATED"),
        (has("ERROR"), "ERROR"),
        (has("OUT"), "OUT"),
    ]
    return first_match(rules, "UNKNOWN")


#: Play-file flags in the order in which they decide.
PLAY_FLAGS = [("hr", "HR"), ("triple", "3B"), ("double", "2B"), ("single", "1B"), ("walk", "BB"), ("hbp", "HBP"), ("k", "K"), ("sf", "SF"), ("sh", "SH"), ("roe", "ERROR"), ("fc", "FC"), ("gdp", "DP"), ("tp", "TP"), ("othout", "OUT"), ("noout", "OUT")]


def flag_code(columns: Iterable[str]) -> Column:
    """Outcome code from 0/1 flags, of those flags that the table has."""
    have = set(columns)
    rules = [(F.col(name).cast("string") == "1", code) for name, code in PLAY_FLAGS if name in have]
    return first_match(rules, "UNKNOWN") if rules else F.lit("UNKNOWN")


def final_outs(event: Column | str, code: Column | str) -> Column:
    """Outs on a game's last plate appearance, which no later one tells."""
    raw, code = F.upper(F.coalesce(_col(event), F.lit(""))), _col(code)
    return F.when(raw.contains("TRIPLE_PLAY"), 3).when(raw.contains("DOUBLE_PLAY"), 2).when(code.isin("OUT", "K", "SF", "SH"), 1).when(code == "DP", 2).when(code == "TP", 3).otherwise(0)


def occupied(first: Column, second: Column, third: Column) -> Column:
    """The bases as a bitmask: 1 first, 2 second, 4 third."""
    return sum(F.when(b, bit).otherwise(0) for b, bit in ((first, 1), (second, 2), (third, 4)))


def bases_from_ids(a: Column | str, b: Column | str, c: Column | str, absent: tuple[str, ...] = ("",)) -> Column:
    on = [F.coalesce(~_col(x).cast("string").isin(*absent), F.lit(False)) for x in (a, b, c)]
    return occupied(*on).cast("long")


# Innings ------------------------------------------------------------------------------------------------

def innings_to_outs(ip: Column | str) -> Column:
    """'6.1', '5 2/3' or '1/3' innings as outs; null if the text says neither."""
    ip = _col(ip)
    number = lambda pattern: F.nullif(F.regexp_extract(ip, pattern, 1), F.lit("")).try_cast("int")
    thirds = F.coalesce(number(r"^([0-9]+) "), F.lit(0)) * 3 + number(r"([12])/3$")
    decimal = number(r"^([0-9]+)") * 3 + F.coalesce(number(r"[.]([0-2])$"), F.lit(0))
    return F.when(ip.endswith("/3"), thirds).otherwise(decimal)


def outs_to_innings(outs: Column | str) -> Column:
    outs = _col(outs)
    return F.concat(F.floor(outs / 3).cast("string"), F.lit("."), (outs % 3).cast("string"))


# Play-by-play text --------------------------------------------------------------------------------------

#: Phrases of Japanese play-by-play by outcome code, in the order in which they decide; * stands for any text.
RESULT_PHRASES = [
    ("SF", ["犠飛", "犠牲フライ"]),
    ("TP", ["三重殺", "トリプルプレー"]),
    ("DP", ["併殺", "ダブルプレー"]),
    ("HR", ["本塁打", "ホームラン"]),
    ("3B", ["三塁打", "スリーベース"]),
    ("2B", ["二塁打", "ツーベース"]),
    ("K", ["スリーバント*失敗", "スリーバントを試みるも*ファウル", "スリーバントを試みるも*空振り"]),
    ("FC", ["スクイズ*本塁*アウト", "スクイズ*本塁*封殺", "スクイズ*ホーム*アウト"]),
    ("OUT", ["送りバント失敗", "スクイズ失敗", "バント失敗", "送りバントを試みるも", "スクイズを試みるも"]),
    ("SH", ["犠打", "送りバント成功", "送りバントを成功", "送りバントを決め", "スクイズ成功", "スクイズを成功", "スクイズを決め", "送りバント*悪送球", "送りバント*エラー", "送りバント*失策", "送りバント*野選", "送りバント*フィルダースチョイス", "スクイズ*悪送球", "スクイズ*エラー", "スクイズ*失策", "スクイズ*野選", "スクイズ*フィルダースチョイス"]),
    ("ERROR", ["失策", "エラー", "ファンブル", "後逸", "悪送球", "落球"]),
    ("FC", ["野選", "フィルダースチョイス"]),
    ("INT", ["打撃妨害"]),
    ("OUT", ["試みるも"]),
    ("1B", ["安打", "ヒット", "セーフティバント", "プッシュバント"]),
    ("BB", ["四球", "フォアボール", "敬遠"]),
    ("HBP", ["死球", "デッドボール"]),
    ("K", ["三振", "振り逃げ"]),
    ("OUT", ["失敗", "バスター", "構えから"]),
    ("SH", ["送りバント", "スクイズ"]),
    ("OUT", ["アウト", "ゴロ", "フライ", "ライナー", "ファウルフライ"]),
]
OUTS_MARKS = {"無死": 0, "一死": 1, "二死": 2}


def phrase_pattern(phrases: Iterable[str]) -> str:
    """A regular expression that finds any of the phrases; ``*`` in a phrase is any text."""
    return "|".join(".*?".join(rf"\Q{part}\E" for part in p.split("*")) for p in phrases)


def result_code(text: Column | str) -> Column:
    """Outcome code of a result text, without its pitch count."""
    body = F.regexp_replace(F.coalesce(_col(text), F.lit("")), r"^[0-9０-９]+球目[:：]", "")
    return first_match([(body.rlike(phrase_pattern(p)), code) for code, p in RESULT_PHRASES], "UNKNOWN")


def runner_bits(text: Column) -> Column:
    return F.when(text.contains("満塁"), 7).otherwise(occupied(text.contains("一"), text.contains("二"), text.contains("三")))


def header_body(header: Column | str) -> Column:
    return F.trim(F.regexp_replace(F.coalesce(_col(header), F.lit("")), r"^＜[^＞]*＞", ""))


def header_outs(header: Column | str) -> Column:
    mark = F.substring(header_body(header), 1, 2)
    return first_match([(mark == k, v) for k, v in OUTS_MARKS.items()], None).cast("long")


def header_bases(header: Column | str) -> Column:
    body = header_body(header)
    return F.when(F.substring(body, 1, 2).isin(*OUTS_MARKS), runner_bits(F.substring(body, 3, 1_000))).cast("long")


def outs_in_text(text: Column | str) -> Column:
    found = F.regexp_extract(F.coalesce(_col(text), F.lit("")), "([0-3０-３])アウト", 1)
    return F.nullif(F.translate(found, "０１２３", "0123"), F.lit("")).try_cast("long")


def bases_in_text(text: Column | str) -> Column:
    found = F.regexp_extract(F.coalesce(_col(text), F.lit("")), r"(満塁|[一二三]+塁)\s*$", 1)
    return F.when(found != "", runner_bits(found)).cast("long")


# Dates, status, statistics ------------------------------------------------------------------------------

def iso_date(c: Column | str) -> Column:
    """'YYYYMMDD' as 'YYYY-MM-DD'; other text is null."""
    c = _col(c).cast("string")
    return F.when(c.rlike(r"^[0-9]{8}$"), F.concat_ws("-", F.substring(c, 1, 4), F.substring(c, 5, 2), F.substring(c, 7, 2)))


def clock(c: Column | str) -> Column:
    c = _col(c).cast("string")
    return F.when(c.rlike(r"^[0-9]{4}$"), F.concat_ws(":", F.substring(c, 1, 2), F.substring(c, 3, 2)))


def league_of(source: Column | str) -> Column:
    return first_match([(_col(source) == s, code) for s, code in SOURCE_LEAGUE.items()], None)


def is_final(status: Column | str) -> Column:
    status = _col(status)
    return F.coalesce(status.isin(*FINAL_VALUES) | F.greatest(*[status.startswith(p) for p in FINAL_PREFIXES]), F.lit(False))


def season_phase(game_type: Column | str, source: Column | str) -> Column:
    """The part of the season of a game; 'unknown' without a type, 'other' where no rule fits."""
    t, s = _col(game_type), _col(source)
    american = s.isin("mlb_statsapi", "retrosheet_local")
    rules = [
        (t.isNull(), "unknown"),
        (s.isin("mlb_statsapi", "retrosheet_local", "kbo_api") & (t == "R"), "regular"),
        (american & t.isin("F", "D", "L", "W") | s.isin("retrosheet_local", "kbo_api") & (t == "P"), "postseason"),
        (s.isin("mlb_statsapi", "retrosheet_local", "kbo_api") & (t == "A"), "allstar"),
        ((s == "mlb_statsapi") & (t == "S"), "preseason"),
        (s.isin("mlb_statsapi", "retrosheet_local", "kbo_api") & (t == "E"), "exhibition"),
        ((s == "npb_spaia") & (t.endswith("公式戦") | (t == "セ・パ交流戦")), "regular"),
        ((s == "npb_spaia") & (t.contains("クライマックスシリーズ") | t.contains("日本シリーズ")), "postseason"),
        ((s == "npb_spaia") & t.contains("オールスター"), "allstar"),
        ((s == "npb_spaia") & t.contains("オープン戦"), "preseason"),
    ]
    return first_match(rules, "other")


def proportion_z(x1: Column, n1: Column, x2: Column, n2: Column, floor: float = 1e-12) -> Column:
    """z of the difference of two proportions, with the pooled variance."""
    pooled = (x1 + x2).cast("double") / (n1 + n2)
    return (x1 / n1.cast("double") - x2 / n2.cast("double")) / F.sqrt(F.greatest(pooled * (1 - pooled) * (1 / n1.cast("double") + 1 / n2.cast("double")), F.lit(floor)))


def mean_z(m1: Column, n1: Column, m2: Column, n2: Column, deviation: float) -> Column:
    return (m1 - m2) / (F.lit(deviation) * F.sqrt(1 / n1.cast("double") + 1 / n2.cast("double")))


def sigmoid(x: Column) -> Column:
    return F.when(x >= 0, 1 / (1 + F.exp(-x))).otherwise(F.exp(x) / (1 + F.exp(x)))
