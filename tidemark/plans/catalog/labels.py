"""Display text and media columns over documents and pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import codes, media, text
from tidemark.plans import star

SITE_LABELS = {
    "src0": "Harian Kompas",
    "src1": "detikcom",
    "src2": "KompasTV",
    "src3": "Radar Bogor",
    "src4": "Memo X",
    "src5": "TRIBUN Jabar",
    "src6": "waspada",
    "src7": "Liputan 6 SCTV",
}


def summaries(spark, d):
    """Whole documents as summaries in both languages, with their headlines and flags."""
    docs = star.documents(spark, d).select("doc_id", "text", "lang", "source")
    c = F.col
    sid = F.when(c("lang") == "en", F.lit("")).otherwise(c("text"))
    base = docs.select(
        "doc_id",
        "source",
        text.summary_for_language(sid, c("text"), "id").alias("summary_id"),
        text.summary_for_language(sid, c("text"), "en").alias("summary_en"),
        text.preferred_headline(sid, c("text"), c("lang"), c("source"), F.lit("place"), c("lang"), "en").alias("headline"),
        text.preferred_headline(sid, c("text"), c("lang"), c("source"), F.lit("place"), c("lang"), "id").alias("place"),
    )
    return base.select(
        "*",
        text.show_headline(c("headline"), c("source")).alias("show_headline"),
        text.show_summary(c("summary_en"), c("headline"), c("source")).alias("show_summary"),
    ).drop("source")


def comparable_text(spark, d):
    docs = star.documents(spark, d)
    return docs.select("doc_id", text.comparable(F.col("text")).alias("comparable"))


def impact_tags(spark, d):
    docs = star.documents(spark, d)
    tags = F.array(
        "lang", F.upper("lang"), F.lit("2023-01"), F.concat("source", F.lit("-X  y")), F.lit(" "), F.lit("2023-01-05"), "source"
    )
    cleaned = text.clean_tags(tags, {"en": "English"})
    return docs.select("doc_id", F.array_join(cleaned, "~").alias("tags"))


def headline_choice(spark, d):
    """Headlines without a usable summary: informative ones stay, generic ones give the place."""
    docs = star.documents(spark, d).join(star.table(spark, d, "labels"), "doc_id", "left")
    c = F.col
    head = F.when(c("quality") == 1, F.lit(" Laporan ")).when(c("toxic") == 0, c("source")).otherwise(F.lit(""))
    place = F.when(c("lang") == "fr", F.lit("")).otherwise(c("lang"))
    chosen = text.preferred_headline(F.lit(""), F.lit(""), head, place, F.lit(""), F.concat(F.lit("d"), c("doc_id")), "en")
    return docs.select("doc_id", chosen.alias("headline"), text.is_generic_headline(head).alias("generic"))


def source_links(spark, d):
    docs = star.documents(spark, d)
    name = F.create_map(*(F.lit(x) for kv in SITE_LABELS.items() for x in kv))[F.col("source")]
    name = F.coalesce(name, F.col("lang"))
    own = F.when(F.col("lang") == "fr", F.lit("https://own.site.org")).otherwise(F.lit("http://localhost/x"))
    return docs.select(
        "doc_id",
        media.source_site(name).alias("site"),
        media.source_href(own, F.lit("ftp://x.org/a"), name).alias("href"),
        media.asset_path(F.concat(F.lit("./data/latest/"), "source", F.lit("/events"))).alias("asset"),
    )


def _forms(spark, d):
    p = star.table(spark, d, "pages").select("page_id", "url")
    vid = F.concat(F.lit("vid_"), codes.padded(F.col("page_id"), 7))
    src = F.replace("url", F.lit(".example."), F.lit(".sample."))
    form = F.col("page_id") % 6
    url = (
        F.when(form == 0, F.concat(F.lit("//www.youtube.com/watch?t=3&v="), vid))
        .when(form == 1, F.concat(F.lit("[clip](https://youtu.be/"), vid, F.lit(")")))
        .when(form == 2, F.concat(F.lit(" m.youtube.com/shorts/"), vid, F.lit("?x=1")))
        .when(form == 3, src)
        .when(form == 4, F.concat(F.lit("HTTPS://Img.Site.org:443/a b/"), vid, F.lit(".JPG?w=1")))
        .otherwise(F.lit(""))
    )
    kind = F.when(form == 3, F.lit("article")).otherwise(F.lit(""))
    return p.select("page_id", "url", url.alias("media_url"), src.alias("source_url"), kind.alias("media_type"))


def public_urls(spark, d):
    f = _forms(spark, d)
    return f.select(
        "page_id",
        media.public_url(F.col("url")).alias("blocked"),
        media.public_url(F.col("source_url")).alias("source"),
        media.public_url(F.col("media_url")).alias("media"),
        media.video_embed_url(F.col("media_url")).alias("embed"),
        media.is_image_url(F.col("media_url")).alias("image"),
        media.is_blocked_host(media.url_host(F.col("url"))).alias("host_blocked"),
    )


def media_candidates(spark, d):
    f = _forms(spark, d)
    m = media.media(F.col("media_type"), F.col("media_url"), F.col("source_url"))
    return f.select("page_id", m.alias("m")).select("page_id", "m.kind", "m.url", "m.fallback")


def best_media(spark, d):
    """Each page's media with the two neighbouring forms of the same page as supporting
    records."""
    f = _forms(spark, d)
    vid = F.concat(F.lit("https://youtu.be/vid_"), codes.padded(F.col("page_id"), 7))
    records = F.array(
        F.struct(F.lit("").alias("media_type"), F.lit("").alias("media_url"), F.lit("").alias("source_url")),
        F.struct(F.lit("").alias("media_type"), F.lit("https://a.site.org/z").alias("media_url"), F.lit("").alias("source_url")),
        F.struct(
            F.lit("").alias("media_type"),
            F.when(F.col("page_id") % 2 == 0, vid).otherwise(F.lit("")).alias("media_url"),
            F.lit("").alias("source_url"),
        ),
    )
    own = media.media(F.col("media_type"), F.col("media_url"), F.col("source_url"))
    staged = f.select("page_id", own.alias("own"), media.supporting_media(records).alias("others"))
    best = media.best_media(F.col("own"), F.col("others"))
    return staged.select(
        "page_id", best.alias("b"), media.media_rank(F.col("own"), F.col("others")).alias("rank")
    ).select("page_id", "b.kind", "b.url", "rank")


QUERIES = {
    "summaries": summaries,
    "comparable_text": comparable_text,
    "impact_tags": impact_tags,
    "headline_choice": headline_choice,
    "source_links": source_links,
    "public_urls": public_urls,
    "media_candidates": media_candidates,
    "best_media": best_media,
}

_STRIP = r"regexp_replace({v}, '^\s+|\s+$', '', 'g')"
_SQUEEZE = r"trim(regexp_replace({v}, '\s+', ' ', 'g'))"
_COMP = r"""trim(regexp_replace(regexp_replace(lower({v}), '[.,!?;:"]', '', 'g'), '\s+', ' ', 'g'))"""
_HEAD = r"""
CASE WHEN length(s) <= 92 THEN s ELSE rtrim(s[1:89]) || '...' END
"""
_MARKERS = ", ".join(f"'{m}'" for m in text.ENGLISH_MARKERS)

_FORMS = """
WITH f AS (
  SELECT page_id, url, replace(url, '.example.', '.sample.') AS src, page_id % 6 AS form,
         'vid_' || printf('%07d', page_id) AS vid FROM pages),
e AS (SELECT *, 'https://www.youtube-nocookie.com/embed/' || vid AS embed,
             'https://img.site.org/a%20b/' || vid || '.JPG?w=1' AS img FROM f)
"""

ORACLES = {
    "summaries": rf"""
WITH b AS (
  SELECT doc_id, source, lang, {_STRIP.format(v='text')} AS t,
         regexp_replace({_SQUEEZE.format(v='text')}, '^(.*?[.!?]) .*$', '\1') AS s FROM documents),
h AS (
  SELECT doc_id, source, t AS summary_en,
         CASE WHEN lang <> 'en' AND len(list_filter([{_MARKERS}], lambda m: contains(' ' || lower(t) || ' ', m))) < 2
              THEN t ELSE '' END AS summary_id,
         CASE WHEN s <> '' THEN {_HEAD} ELSE lang END AS headline, source AS place FROM b),
k AS (
  SELECT *, {_COMP.format(v='summary_en')} AS cs, {_COMP.format(v='source')} AS cl,
         {_COMP.format(v="regexp_replace(headline, '[.][.][.]$', '')")} AS ch FROM h)
SELECT doc_id, summary_id, summary_en, headline, place,
       headline <> '' AND {_COMP.format(v='headline')} <> cl AS show_headline,
       summary_en <> '' AND NOT (cs <> '' AND ch <> '' AND starts_with(cs, ch)) AND cs <> cl AS show_summary
FROM k""",
    "comparable_text": f"SELECT doc_id, {_COMP.format(v='text')} AS comparable FROM documents",
    "impact_tags": """
SELECT doc_id, CASE WHEN lang = 'en' THEN 'English' ELSE lang END || '~' || source || ' x y~' || source AS tags
FROM documents""",
    "headline_choice": """
SELECT doc_id, CASE WHEN quality IS DISTINCT FROM 1 AND toxic = 0 THEN source
                    WHEN lang = 'fr' THEN 'd' || doc_id ELSE lang END AS headline,
       coalesce(quality = 1, false) AS generic
FROM documents LEFT JOIN labels USING (doc_id)""",
    "source_links": """
WITH s AS (
  SELECT doc_id, lang, source, CASE source
    WHEN 'src0' THEN 'https://www.kompas.com' WHEN 'src1' THEN 'https://www.detik.com'
    WHEN 'src2' THEN 'https://www.kompas.com' WHEN 'src3' THEN 'https://radarbogor.jawapos.com'
    WHEN 'src4' THEN 'https://memox.co.id' WHEN 'src5' THEN 'https://www.tribunnews.com'
    WHEN 'src6' THEN 'https://waspada.id' WHEN 'src7' THEN 'https://www.liputan6.com' ELSE '' END AS site
  FROM documents)
SELECT doc_id, site, CASE WHEN lang = 'fr' THEN 'https://own.site.org/' WHEN site = '' THEN '' ELSE site || '/' END AS href,
       source || '/events' AS asset FROM s""",
    "public_urls": _FORMS
    + """
SELECT page_id, '' AS blocked, src AS source,
       CASE form WHEN 0 THEN 'https://www.youtube.com/watch?t=3&v=' || vid WHEN 1 THEN ''
         WHEN 2 THEN 'https://m.youtube.com/shorts/' || vid || '?x=1' WHEN 3 THEN src WHEN 4 THEN img ELSE '' END AS media,
       CASE WHEN form < 3 THEN embed ELSE '' END AS embed, form = 4 AS image, true AS host_blocked
FROM e""",
    "media_candidates": _FORMS
    + """
SELECT page_id, CASE WHEN form < 3 THEN 'video' WHEN form = 3 THEN 'link' WHEN form = 4 THEN 'image' ELSE '' END AS kind,
       CASE WHEN form < 3 THEN embed WHEN form = 3 THEN src WHEN form = 4 THEN img ELSE '' END AS url, src AS fallback
FROM e""",
    "best_media": _FORMS
    + """
SELECT page_id,
       CASE WHEN form < 3 OR page_id % 2 = 0 THEN 'video' WHEN form = 3 THEN 'link' ELSE 'link' END AS kind,
       CASE WHEN form < 3 OR page_id % 2 = 0 THEN embed WHEN form = 3 THEN src ELSE 'https://a.site.org/z' END AS url,
       CAST(CASE WHEN form < 3 THEN 3 WHEN page_id % 2 = 0 THEN 2 WHEN form IN (3, 4) THEN 1 ELSE 0 END AS INTEGER) AS rank
FROM e""",
}
