"""Topic names and notification text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skytide.naming import DEFAULT_NAMING, Naming

# Characters with a meaning in the messenger's markdown.
MARKDOWN_SPECIAL = r"([_*\[\]()~>#+\-=|{}.!])"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def legal_topic_name(topic: Column | str) -> Column:
    """Letters only, lower case."""
    return F.lower(F.regexp_replace(_col(topic), r"[^\p{L}]", ""))


def escape_markdown(text: Column | str) -> Column:
    return F.regexp_replace(_col(text), MARKDOWN_SPECIAL, r"\\$1")


def tag_topic_name(tag: Column | str, naming: Naming = DEFAULT_NAMING) -> Column:
    return F.concat(F.lit(f"{naming.namespace}_"), _col(tag), F.lit("_lsst"))


def notification_text(
    kind: Column | str,
    object_id: Column | str,
    topic: Column | str,
    survey: str,
    naming: Naming = DEFAULT_NAMING,
) -> Column:
    """Message body: the object as a link, then its topic.

    Telegram understands ``[text](link)``; Slack gets the bare link.
    """
    oid = _col(object_id).cast("string")
    link = F.concat(F.lit(f"https://{survey}.{naming.portal_host}/"), oid)
    shown = F.when(_col(kind) == "telegram", F.concat(F.lit("["), oid, F.lit("]("), link, F.lit(")"))).otherwise(link)
    # Fixed layout: the message starts with a line break and ends with an indent.
    return F.concat(F.lit("\n*Object ID*: "), shown, F.lit("\n*Topic*: `"), _col(topic), F.lit("`\n    "))
