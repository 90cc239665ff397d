"""URL and media columns: public links, video embeds, image tests, best media."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.text import let, lowered, or_empty, strip

# Hosts that are never public.
LOCAL_HOSTS = ("localhost", "127.0.0.1", "0.0.0.0")
BLOCKED_PATTERN = r"(?:^|\.)example\.(?:com|org|net)$|\.local$"

# Video hosts accepted without a scheme, and the id pattern of their links.
BARE_VIDEO_PATTERN = r"(?i)^((?:www\.)?(?:youtube\.com|m\.youtube\.com|youtu\.be|youtube-nocookie\.com)/)"
VIDEO_ID_PATTERN = (
    r"(?i)(?:youtu\.be/|youtube(?:-nocookie)?\.com/(?:watch\?v=|embed/|shorts/|live/))"
    r"([A-Za-z0-9_-]{6,})"
)
EMBED_PREFIX = "https://www.youtube-nocookie.com/embed/"
IMAGE_PATTERN = r"(?i)\.(avif|gif|jpe?g|png|webp)$"

# Source label fragment to home page, first match wins.
SOURCE_SITES = (
    ("ayo bandung", "https://www.ayobandung.com"),
    ("kompas", "https://www.kompas.com"),
    ("berita jakarta", "https://www.beritajakarta.id"),
    ("suara merdeka", "https://www.suaramerdeka.com"),
    ("antara", "https://www.antaranews.com"),
    ("tempo", "https://www.tempo.co"),
    ("liputan 6", "https://www.liputan6.com"),
    ("liputan6", "https://www.liputan6.com"),
    ("tribun", "https://www.tribunnews.com"),
    ("metrotv", "https://www.metrotvnews.com"),
    ("kompastv", "https://www.youtube.com/@KOMPASTV"),
    ("tvone", "https://www.tvonenews.com"),
    ("detik", "https://www.detik.com"),
    ("cnn indonesia", "https://www.cnnindonesia.com"),
    ("harian analisa", "https://www.hariananalisa.com"),
    ("jawa pos", "https://www.jawapos.com"),
    ("kawentar", "https://kawentar.com"),
    ("magelang ekspres", "https://magelangekspres.disway.id"),
    ("malang post", "https://malang-post.com"),
    ("memo x", "https://memox.co.id"),
    ("memox", "https://memox.co.id"),
    ("pantura post", "https://panturapost.com"),
    ("pikiran rakyat", "https://www.pikiran-rakyat.com"),
    ("radar bogor", "https://radarbogor.jawapos.com"),
    ("radar kediri", "https://radarkediri.jawapos.com"),
    ("radar pekalongan", "https://radarpekalongan.id"),
    ("siantar 24 jam", "https://siantar24jam.com"),
    ("solopos", "https://www.solopos.com"),
    ("sukabumi update", "https://sukabumiupdate.com"),
    ("waspada", "https://waspada.id"),
)

_AUTHORITY = r"(?i)^https?://(?:[^/?#@]*@)?([^/?#:]*)"


def url_host(url: Column) -> Column:
    return F.lower(F.regexp_extract(or_empty(url), _AUTHORITY, 1))


def url_path(url: Column) -> Column:
    return F.regexp_extract(or_empty(url), r"(?i)^https?://[^/?#]*([^?#]*)", 1)


def is_blocked_host(host: Column) -> Column:
    return let(
        F.regexp_replace(lowered(host), r"^www\.", ""),
        lambda h: (h == "") | h.isin(*LOCAL_HOSTS) | h.rlike(BLOCKED_PATTERN),
    )


def public_url(raw: Column) -> Column:
    """Absolute http(s) address on a public host, host in lower case and the root path
    spelled out; anything else is empty."""
    text = F.regexp_replace(strip(raw), r"^//", "https://")
    text = F.regexp_replace(text, BARE_VIDEO_PATTERN, "https://$1")

    def parts(t: Column) -> Column:
        return F.struct(
            F.lower(F.regexp_extract(t, r"(?i)^(https?)://", 1)).alias("scheme"),
            F.regexp_extract(t, r"(?i)^https?://([^/?#@]*@)", 1).alias("user"),
            url_host(t).alias("host"),
            F.regexp_extract(t, r"(?i)^https?://(?:[^/?#@]*@)?[^/?#:]*(:\d+)?", 1).alias("port"),
            F.replace(url_path(t), F.lit(" "), F.lit("%20")).alias("path"),
            F.replace(F.regexp_extract(t, r"(?i)^https?://[^?#]*(.*)$", 1), F.lit(" "), F.lit("%20")).alias("rest"),
        )

    def joined(u: Column) -> Column:
        default = F.when(u["scheme"] == "http", F.lit(":80")).otherwise(F.lit(":443"))
        ok = (u["scheme"] != "") & ~is_blocked_host(u["host"]) & ~u["host"].rlike(r"[\s<>^|%]")
        clean = F.concat(
            u["scheme"],
            F.lit("://"),
            u["user"],
            u["host"],
            F.when(u["port"] == default, F.lit("")).otherwise(u["port"]),
            F.coalesce(F.nullif(u["path"], F.lit("")), F.lit("/")),
            u["rest"],
        )
        return F.when(ok, clean).otherwise(F.lit(""))

    return let(let(text, parts), joined)


def asset_path(path: Column) -> Column:
    """Relative asset path without the leading ``./`` and release folder."""
    return F.regexp_replace(F.regexp_replace(or_empty(path), r"^\./", ""), r"^data/latest/", "")


def video_embed_url(url: Column) -> Column:
    """Embed address of a video link in any of its written forms, else empty."""
    text = F.regexp_replace(strip(url), r"(?i)^\[[^\]]*\]\((https?://[^)\s]+)\)$", "$1")
    text = F.regexp_replace(F.regexp_replace(text, r"^<|>$", ""), r"^//", "https://")
    text = F.regexp_replace(
        text, r"(?is)^(?!https?://)/*(?=.*(?:youtube\.com|youtu\.be))", "https://"
    )

    def parts(t: Column) -> Column:
        return F.struct(
            F.regexp_replace(url_host(t), r"^www\.", "").alias("host"),
            url_path(t).alias("path"),
            F.regexp_extract(t, r"^[^?#]*\?(?:[^#]*&)?v=([^&#]*)", 1).alias("query_id"),
            F.regexp_extract(t, VIDEO_ID_PATTERN, 1).alias("anywhere"),
        )

    def pick(u: Column) -> Column:
        long_host = u["host"].isin("youtube.com", "m.youtube.com", "youtube-nocookie.com")
        by_host = (
            F.when(u["host"] == "youtu.be", F.regexp_extract(u["path"], r"^/+([^/]+)", 1))
            .when(long_host & (u["path"] == "/watch"), u["query_id"])
            .when(long_host, F.regexp_extract(u["path"], r"^/(?:embed|shorts|live)/([^/]*)", 1))
        )
        blank = F.lit("")
        video = F.coalesce(F.nullif(by_host, blank), F.nullif(u["anywhere"], blank))
        return F.coalesce(F.concat(F.lit(EMBED_PREFIX), video), blank)

    return let(let(text, parts), pick)


def is_image_url(url: Column) -> Column:
    bare = F.regexp_replace(or_empty(url), r"[?#].*$", "")
    path = F.coalesce(F.nullif(url_path(url), F.lit("")), bare)
    return path.rlike(IMAGE_PATTERN)


def media(media_type: Column, media_url: Column, source_url: Column) -> Column:
    """``struct(kind, url, fallback)``; kind is video, image, link or empty."""
    blank = F.lit("")
    embed = F.coalesce(F.nullif(video_embed_url(media_url), blank), video_embed_url(source_url))
    found = F.struct(
        lowered(media_type).alias("type"),
        public_url(media_url).alias("own"),
        public_url(source_url).alias("source"),
        embed.alias("embed"),
    )

    def classify(m: Column) -> Column:
        source_first = F.coalesce(F.nullif(m["source"], blank), m["own"])
        image = (m["type"] == "image") | is_image_url(m["own"])
        kind = (
            F.when(m["embed"] != "", F.lit("video"))
            .when(m["own"] == "", blank)
            .when((m["type"] != "video") & image, F.lit("image"))
            .otherwise(F.lit("link"))
        )
        url = (
            F.when(m["embed"] != "", m["embed"])
            .when(m["own"] == "", blank)
            .when((m["type"] == "video") | image, m["own"])
            .otherwise(source_first)
        )
        fallback = F.when((m["embed"] == "") & (m["own"] == ""), m["source"]).otherwise(source_first)
        return F.struct(kind.alias("kind"), url.alias("url"), fallback.alias("fallback"))

    return let(found, classify)


def supporting_media(records: Column) -> Column:
    """Media of the supporting records that have an address, in order."""
    found = F.transform(
        records, lambda r: media(r["media_type"], r["media_url"], r["source_url"])
    )
    return F.filter(found, lambda m: m["url"] != "")


def best_media(own: Column, others: Column, related: Column | None = None) -> Column:
    """Own video, supporting video, own address, first supporting; a related video
    replaces anything that is not a video."""
    none = F.struct(F.lit("").alias("kind"), F.lit("").alias("url"), F.lit("").alias("fallback"))
    video = F.get(F.filter(others, lambda m: m["kind"] == "video"), F.lit(0))
    best = F.when(own["kind"] == "video", own).otherwise(
        F.coalesce(video, F.when(own["url"] != "", own), F.get(others, F.lit(0)), none)
    )
    if related is None:
        return best
    late = F.get(F.filter(related, lambda m: m["kind"] == "video"), F.lit(0))
    return F.when(best["kind"] == "video", best).otherwise(F.coalesce(late, best))


def media_rank(own: Column, others: Column) -> Column:
    """3 own video, 2 supporting video, 1 own address, 0 nothing."""
    return (
        F.when(own["kind"] == "video", 3)
        .when(F.exists(others, lambda m: m["kind"] == "video"), 2)
        .when(own["url"] != "", 1)
        .otherwise(0)
    )


def source_site(name: Column) -> Column:
    """Home page for a source label, by the first matching fragment."""
    rules = F.array(
        *(F.struct(F.lit(f).alias("fragment"), F.lit(u).alias("url")) for f, u in SOURCE_SITES)
    )
    first = let(
        lowered(name),
        lambda label: F.get(F.filter(rules, lambda r: F.contains(label, r["fragment"])), F.lit(0)),
    )
    return F.coalesce(first["url"], F.lit(""))


def source_href(source_url: Column, media_url: Column, name: Column) -> Column:
    blank = F.lit("")
    return F.coalesce(
        F.nullif(public_url(source_url), blank),
        F.nullif(public_url(media_url), blank),
        public_url(source_site(name)),
    )
