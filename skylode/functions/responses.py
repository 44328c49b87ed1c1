"""What a publishing service is sent and what it answers, as Column expressions over JSON texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skylode.functions.text import last_wins, let, present, strip

# Types of uploads by suffix, states worth another try, platforms that take no post without media.
CONTENT_TYPES = {".mp4": "video/mp4", ".mov": "video/quicktime", ".webm": "video/webm", ".jpg": "image/jpeg", ".jpeg": "image/jpeg", ".png": "image/png", ".webp": "image/webp"}
RETRY = (429, 500, 502, 503, 504)
MEDIA_ONLY = ("instagram", "tiktok")

POST = "post struct<_id: string, platforms: array<struct<platform: string, accountId: string, status: string, error: string>>>"


def content_type(name: Column) -> Column:
    """Type of a file by its suffix, whatever the case; NULL if it isn't known."""
    known = F.create_map(*[F.lit(x) for pair in CONTENT_TYPES.items() for x in pair])
    return F.try_element_at(known, F.lower(F.regexp_extract(name, r"(\.[^./\\]+)$", 1)))


def media_kind(name: Column) -> Column:
    """video or image; NULL if the type isn't known."""
    kind = content_type(name)
    return F.when(kind.startswith("video/"), "video").when(kind.isNotNull(), "image")


def retryable(status: Column) -> Column:
    return F.coalesce(status.isin(*RETRY), F.lit(False))


def _objects(text: Column, schema: str, f) -> Column:
    """``f`` of a JSON object with ``schema``; NULL for anything else."""
    return F.when(text.startswith("{"), let(F.from_json(text, schema), f))


def error_text(status: Column, body: Column, hint: str = "check the key") -> Column:
    """One line for an error answer: its message, up to five of the issues it names, and a hint if access was denied.

    A message may be text or an object that holds one; without any, the whole body stands for it. A body that isn't JSON is
    quoted, at most 400 characters, in one line; an empty or NULL one counts as an empty object.
    """
    text = F.coalesce(present(strip(body)), F.lit("{}"))
    fields = "message string, error string, issues array<string>"

    def inner(x: Column) -> Column:
        return F.when(x.startswith("{"), F.coalesce(present(F.get_json_object(x, "$.message")), x)).otherwise(x)

    def issue(x: Column) -> Column:
        def line(p: Column) -> Column:
            what = F.coalesce(present(p["message"]), present(p["code"]), x)
            return F.concat_ws(": ", present(F.array_join(p["path"], ".")), what)

        return F.coalesce(_objects(x, "path array<string>, message string, code string", line), x)

    def whole(p: Column) -> Column:
        message = F.coalesce(inner(F.coalesce(present(p["message"]), present(p["error"]))), text)
        listed = F.concat(F.lit(" ("), F.array_join(F.transform(F.slice(p["issues"], 1, 5), issue), "; "), F.lit(")"))
        return F.concat(message, F.when(F.size(p["issues"]) > 0, listed).otherwise(""), F.when(status == 401, f" — {hint}").otherwise(""))

    quoted = F.concat(F.lit("invalid response (HTTP "), status.cast("string"), F.lit("): "), F.regexp_replace(F.substring(body, 1, 400), "\n", " "))
    return F.when(F.try_parse_json(text).isNull(), quoted).otherwise(F.coalesce(_objects(text, fields, whole), text))


def delivery(platforms: Column) -> Column:
    """{platform: state} of rows (platform, status, error): states in lower case, unknown without one, with the error behind it.

    Of several rows of a platform the last counts; a row without platform is named ?. NULL rows don't count.
    """
    rows = F.array_compact(platforms)
    error = lambda r: present(strip(r["error"]))
    state = lambda r: F.concat_ws(": ", F.coalesce(present(F.lower(r["status"])), F.lit("unknown")), error(r))
    return let(rows, lambda a: last_wins(F.transform(a, lambda r: F.coalesce(present(r["platform"]), F.lit("?"))), F.transform(a, state)))


def failed_delivery(states: Column) -> Column:
    """Whether any platform's state starts with failed or error."""
    return F.exists(F.map_values(states), lambda s: s.startswith("failed") | s.startswith("error"))


def published(response: Column) -> Column:
    """(post_id, accounts, states): what is kept of an answer to a post, by platform; all NULL if nothing was published."""
    def kept(post: Column) -> Column:
        rows = F.filter(F.array_compact(post["platforms"]), lambda r: present(r["platform"]).isNotNull())
        accounts = let(rows, lambda a: last_wins(F.transform(a, lambda r: r["platform"]), F.transform(a, lambda r: F.coalesce(r["accountId"], F.lit("")))))
        there = present(post["_id"]).isNotNull()
        return F.struct(present(post["_id"]).alias("post_id"), F.when(there, accounts).alias("accounts"), F.when(there, delivery(post["platforms"])).alias("states"))

    return let(F.from_json(response, POST)["post"], kept)


def account_rows(answer: Column) -> Column:
    """(platform, account_id) rows of a list of accounts, bare or in an envelope; those without either are left out."""
    kind = "array<struct<platform: string, _id: string>>"
    rows = F.coalesce(F.from_json(answer, f"struct<accounts: {kind}>")["accounts"], F.from_json(answer, kind))
    kept = F.filter(F.array_compact(rows), lambda r: present(r["platform"]).isNotNull() & present(r["_id"]).isNotNull())
    return F.transform(kept, lambda r: F.struct(r["platform"].alias("platform"), r["_id"].alias("account_id")))


def wanted_accounts(accounts: Column, wanted: Column) -> Column:
    """Of ``accounts`` (platform to id) those of the ``wanted`` platforms, in the order wanted; all if none is named."""
    there = F.array_intersect(wanted, F.map_keys(accounts))
    chosen = F.map_from_arrays(there, F.transform(there, lambda p: F.try_element_at(accounts, p)))
    return F.when(F.coalesce(F.size(wanted), F.lit(0)) <= 0, accounts).otherwise(chosen)


def post_problem(accounts: Column, media_url: Column) -> Column:
    """Why a post can't be made: no account, or a platform that needs media gets none; NULL if it can."""
    bare = F.array_sort(F.array_intersect(F.map_keys(accounts), F.array(*[F.lit(p) for p in MEDIA_ONLY])))
    return F.when(F.coalesce(F.size(accounts), F.lit(0)) <= 0, "no connected accounts").when((F.size(bare) > 0) & present(media_url).isNull(), F.concat(F.array_join(bare, ", "), F.lit(" require media")))


def post_body(caption: Column, accounts: Column, media_url: Column, kind: Column, profile: Column, cover_ms: Column, reel: bool = True) -> Column:
    """The JSON text of a post to each of ``accounts`` (platform to id); NULL where :func:`post_problem` says why not."""
    def entry(e: Column) -> Column:
        reels = F.struct(F.lit("reels").alias("contentType"), F.lit(True).alias("shareToFeed"), (cover_ms.cast("bigint") * 1000).alias("thumbOffset"))
        return F.struct(e["key"].alias("platform"), e["value"].alias("accountId"), F.when((e["key"] == "instagram") & F.lit(reel), reels).alias("platformSpecificData"))

    media = F.when(present(media_url).isNotNull(), F.array(F.struct(media_url.alias("url"), kind.alias("type"))))
    whole = F.struct(F.coalesce(present(strip(caption)), F.lit(" ")).alias("content"), F.transform(F.map_entries(accounts), entry).alias("platforms"), F.lit(True).alias("publishNow"), present(profile).alias("profileId"), media.alias("mediaItems"))
    return F.when(post_problem(accounts, media_url).isNull(), F.to_json(whole, {"ignoreNullFields": "true"}))
