"""Asset and tag masters, and the joins of messages to them."""

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kilnstream import fixed, schemas
from kilnstream.functions import text
from kilnstream.functions.text import quoted
from kilnstream.operators.lookup import BROADCAST_LIMIT, Lookup, join_lookup, measure

# Issues found in the masters.
BAD_LIMIT = "limit is not a number"
ALIAS_MISSING = "alias missing"
ALIAS_TAKEN = "alias used by an earlier tag"
BAD_KEY = "mapping key missing"
NO_TAGS = "modelled asset without tags"


def site_rows(master: DataFrame, site: str) -> DataFrame:
    return master.where(F.col("site_id") == site)


def scan_assets(assets: DataFrame, site: str) -> DataFrame:
    return site_rows(assets, site).select(*schemas.ASSET_SCAN_COLUMNS)


def with_code_names(tags: DataFrame, codes: DataFrame) -> DataFrame:
    """Add ``data_type_nm``, the name of the tag's type code; NULL when unknown."""
    names = (
        codes.where(F.col("code_group") == fixed.TYPE_CODE_GROUP)
        .groupBy(F.col("code").alias("data_type_cd"))
        .agg(F.min("code_name").alias("data_type_nm"))
    )
    return tags.join(names, "data_type_cd", "left")


def scan_tags(tags: DataFrame, codes: DataFrame, site: str, limits: bool = False) -> DataFrame:
    """Tag metadata of a site with type names, with or without the six limits."""
    columns = schemas.TAG_LIMIT_SCAN_COLUMNS if limits else schemas.TAG_SCAN_COLUMNS
    named = with_code_names(site_rows(tags, site).select(*columns), codes)
    return named.select(*columns[:-1], "data_type_nm")


def confirmed_assets(assets: DataFrame, site: str) -> DataFrame:
    """Ids of the site's assets with a confirmed model, each once."""
    return (
        site_rows(assets, site)
        .where(F.col("model_confirm_yn") == fixed.CONFIRMED)
        .select("asset_id")
        .distinct()
    )


def prepare_tags(tags: DataFrame, codes: DataFrame, site: str) -> DataFrame:
    """Tag metadata in the form the per-message expressions want.

    Limits are parsed here, once per tag and not once per message.  Text that is
    no number, and NaN, mean "no limit".
    """
    scanned = scan_tags(tags, codes, site, limits=True)
    number = {name: f"try_cast(trim({name}) AS DOUBLE)" for name in fixed.LIMIT_COLUMNS}
    limits = [f"CASE WHEN NOT isnan({n}) THEN {n} END AS {name}" for name, n in number.items()]
    bad = " OR ".join(
        f"({name} IS NOT NULL AND coalesce(isnan({n}), true))" for name, n in number.items()
    )
    return scanned.selectExpr(
        "site_id", "asset_id", "tag_id", "tag_nm", "alias", "mapping_key",
        f"{text.pad_single('mapping_key')} AS key_part",
        *limits,
        f"coalesce(contains(data_type_nm, {quoted(fixed.DOUBLE_TYPE_WORD)}), false) AS double_tag",
        f"{bad} AS bad_limit",
    )


def alias_tags(tags: DataFrame) -> DataFrame:
    """Prepared tags that own a wide column: the first tag id of each alias."""
    columns = [c for c in tags.columns if c not in ("asset_id", "alias")]
    return (
        tags.where(F.col("alias").isNotNull())
        .groupBy("asset_id", "alias")
        .agg(F.min_by(F.struct(*columns), F.struct("tag_id", "mapping_key")).alias("t"))
        .select("asset_id", "alias", "t.*")
    )


@dataclass(frozen=True)
class Masters:
    """One snapshot of the masters of a site, measured."""

    site: str
    confirmed: Lookup  # asset_id
    tags: Lookup  # prepared tags of confirmed assets

    def release(self) -> None:
        self.confirmed.frame.unpersist()
        self.tags.frame.unpersist()


def load_masters(
    assets: DataFrame, tags: DataFrame, codes: DataFrame, site: str, keep: bool = False
) -> Masters:
    """Read, prepare and measure the masters; ``keep`` caches them for many joins.

    Tags of unconfirmed assets are dropped here, so that joining messages to the
    tags also tells modelled assets from the others.
    """
    confirmed = confirmed_assets(assets, site)
    confirmed = confirmed.persist() if keep else confirmed
    prepared = prepare_tags(tags, codes, site).join(confirmed, "asset_id", "left_semi")
    prepared = prepared.persist() if keep else prepared
    return Masters(site, *measure(confirmed, prepared))


def with_tags(masters: Masters, tags: DataFrame) -> Masters:
    """The masters with other prepared tags, measured."""
    return Masters(masters.site, masters.confirmed, *measure(tags))


def modelled(
    messages: DataFrame, masters: Masters, limit: int = BROADCAST_LIMIT
) -> DataFrame:
    """Messages of assets with a confirmed model at this site."""
    return join_lookup(messages, masters.confirmed, ["asset_id"], "left_semi", limit)


def unmodelled(messages: DataFrame, masters: Masters) -> DataFrame:
    """The complement: stored as documents, but nothing more."""
    return join_lookup(messages, masters.confirmed, ["asset_id"], "left_anti")


def master_issues(masters: Masters) -> DataFrame:
    """Defects of the masters, one row per asset, tag and issue."""
    tags = masters.tags.frame
    owners = alias_tags(tags).select("asset_id", "alias", F.col("tag_id").alias("owner"))
    checked = tags.join(owners, ["asset_id", "alias"], "left")
    found = F.expr(f"""array_compact(array(
        CASE WHEN bad_limit THEN {quoted(BAD_LIMIT)} END,
        CASE WHEN mapping_key IS NULL THEN {quoted(BAD_KEY)} END,
        CASE WHEN alias IS NULL THEN {quoted(ALIAS_MISSING)} END,
        CASE WHEN owner <> tag_id THEN {quoted(ALIAS_TAKEN)} END))""")
    of_tags = checked.select("asset_id", "tag_id", F.explode(found).alias("issue"))
    tagless = masters.confirmed.frame.join(tags.select("asset_id"), "asset_id", "left_anti")
    return of_tags.unionByName(
        tagless.select(
            "asset_id", F.lit(None).cast("string").alias("tag_id"), F.lit(NO_TAGS).alias("issue")
        )
    )
