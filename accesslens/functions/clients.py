"""Client classification from the User-Agent text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from accesslens.functions.addresses import trimmed

# Token, family, kind. The first token found wins.
CLIENT_RULES: tuple[tuple[str, str, str], ...] = (
    ("happ", "Happ", "client"),
    ("streisand", "Streisand", "client"),
    ("hiddify", "Hiddify", "client"),
    ("v2rayng", "v2rayNG", "client"),
    ("v2raytun", "v2RayTun", "client"),
    ("v2rayn", "v2rayN", "client"),
    ("nekobox", "NekoBox", "client"),
    ("nekoray", "NekoRay", "client"),
    ("shadowrocket", "Shadowrocket", "client"),
    ("stash", "Stash", "client"),
    ("loon", "Loon", "client"),
    ("quantumult", "Quantumult", "client"),
    ("surge", "Surge", "client"),
    ("clash-verge", "Clash Verge", "client"),
    ("clashx", "ClashX", "client"),
    ("clash", "Clash", "client"),
    ("mihomo", "Mihomo", "client"),
    ("sing-box", "sing-box", "client"),
    ("singbox", "sing-box", "client"),
    ("foxray", "FoXray", "client"),
    ("karing", "Karing", "client"),
    ("throne", "Throne", "client"),
    ("husi", "Husi", "client"),
    ("exclave", "Exclave", "client"),
    ("matsuri", "Matsuri", "client"),
    ("v2box", "V2Box", "client"),
    ("sfa", "sing-box for Android", "client"),
    ("sfi", "sing-box for iOS", "client"),
    ("sfm", "sing-box for macOS", "client"),
    ("curl", "curl", "script"),
    ("wget", "wget", "script"),
    ("python-requests", "python-requests", "script"),
    ("python-urllib", "python-urllib", "script"),
    ("aiohttp", "aiohttp", "script"),
    ("httpx", "httpx", "script"),
    ("go-http-client", "Go-http-client", "script"),
    ("okhttp", "OkHttp", "script"),
    ("axios", "axios", "script"),
    ("node-fetch", "node-fetch", "script"),
    ("powershell", "PowerShell", "script"),
    ("java/", "Java", "script"),
    ("libwww-perl", "libwww-perl", "script"),
    ("postman", "Postman", "script"),
    ("insomnia", "Insomnia", "script"),
    ("telegrambot", "TelegramBot", "bot"),
    ("crawler", "Crawler", "bot"),
    ("spider", "Spider", "bot"),
    ("bot", "Bot", "bot"),
    ("edg/", "Edge", "browser"),
    ("opr/", "Opera", "browser"),
    ("yabrowser", "Yandex Browser", "browser"),
    ("firefox", "Firefox", "browser"),
    ("chrome", "Chrome", "browser"),
    ("safari", "Safari", "browser"),
    ("mozilla", "Browser", "browser"),
)
EMPTY_FAMILY, OTHER_FAMILY, UNKNOWN_KIND = "(empty)", "Other", "unknown"


def ua_classify(user_agent: str) -> Column:
    """``struct<family STRING, kind STRING>`` of a raw User-Agent.

    ``user_agent`` is SQL text naming the value. One ``CASE`` finds the number
    of the first rule that applies and two constant arrays translate it. Both
    fields share that ``CASE``, which Spark evaluates once per row as a common
    subexpression.
    """
    text = f"lower({trimmed(user_agent)})"
    tests = " ".join(
        f"WHEN contains({text}, '{token}') THEN {number}"
        for number, (token, _, _) in enumerate(CLIENT_RULES, start=1)
    )
    known = len(CLIENT_RULES)
    rule = f"CASE WHEN {text} = '' THEN {known + 1} {tests} ELSE {known + 2} END"

    def names(values: list[str]) -> str:
        return "array(" + ", ".join(f"'{v}'" for v in values) + ")"

    families = names([family for _, family, _ in CLIENT_RULES] + [EMPTY_FAMILY, OTHER_FAMILY])
    kinds = names([kind for _, _, kind in CLIENT_RULES] + [UNKNOWN_KIND, UNKNOWN_KIND])
    return F.expr(
        f"named_struct('family', element_at({families}, {rule}), 'kind', element_at({kinds}, {rule}))"
    )


def is_scripted(kind: Column) -> Column:
    """True for clients that are scripts or declared bots."""
    return kind.isin("script", "bot")
