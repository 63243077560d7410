from accesslens.functions.clients import CLIENT_RULES, ua_classify
from accesslens.functions.hosting import HOSTING_KEYWORDS, hosting_flag

CASES = {
    "com.happproxy/2.9 HAPP": ("Happ", "client"),
    "Streisand 1.7 build 90": ("Streisand", "client"),
    "ClashX Pro/1.118": ("ClashX", "client"),
    "clash.meta/v1.16": ("Clash", "client"),
    "Shadowrocket/2070 CFNetwork": ("Shadowrocket", "client"),
    "SFM 1.10 Mac": ("sing-box for macOS", "client"),
    "Wget/1.21.4": ("wget", "script"),
    "okhttp/4.12.0": ("OkHttp", "script"),
    "Java/17.0.9": ("Java", "script"),
    "Baiduspider/2.0": ("Spider", "bot"),
    "AhrefsBot": ("Bot", "bot"),
    "Mozilla/5.0 (Macintosh) Gecko/2010 Firefox/128.0": ("Firefox", "browser"),
    "Mozilla/5.0 (Linux) AppleWebKit Chrome/130 Safari/537 Edg/130": ("Edge", "browser"),
    "mozilla only": ("Browser", "browser"),
    "": ("(empty)", "unknown"),
    "\n \t": ("(empty)", "unknown"),
    "some thing else 9": ("Other", "unknown"),
}


def classified(spark, agents):
    df = spark.createDataFrame([(a,) for a in agents], "agent string")
    rows = df.select("agent", ua_classify("agent").alias("c")).collect()
    return {r.agent: (r.c.family, r.c.kind) for r in rows}


def test_known_agents(spark):
    assert classified(spark, CASES) == CASES


def test_every_rule_wins_over_later_ones(spark):
    """A text holding one token and all later tokens goes to the first."""
    texts = {}
    for i, (token, family, kind) in enumerate(CLIENT_RULES):
        later = " ".join(t for t, _, _ in CLIENT_RULES[i:])
        first = next(r for r in CLIENT_RULES if r[0] in later)
        texts[f"X {later.upper()}"] = (first[1], first[2])
        assert token in later
    assert classified(spark, texts) == texts


def test_rule_counts():
    kinds = [kind for _, _, kind in CLIENT_RULES]
    assert [kinds.count(k) for k in ("client", "script", "bot", "browser")] == [29, 15, 4, 7]
    assert len(HOSTING_KEYWORDS) == 40


def test_hosting(spark):
    cases = {
        "Contabo Inc": 1, "Leaseweb Sweden": 1, "TENCENT-NET": 1, "Some Data Center BV": 1, "Aws Global": 1,
        "City Fibre Oy": 0, "Rural Telephone Coop": 0, "Kabel Nord": 0, "": 0,
    }
    df = spark.createDataFrame([(o,) for o in cases], "org string")
    assert {r.org: r.h for r in df.select("org", hosting_flag("org").alias("h")).collect()} == cases
    own = df.select("org", hosting_flag("org", ["KABEL", "o'x"]).alias("h")).collect()
    assert [r.org for r in own if r.h] == ["Kabel Nord"]
