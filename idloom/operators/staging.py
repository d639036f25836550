"""Cleaning layer: one ``select`` per raw source, driven by a declarative spec.

Each spec line is ``column  warehouse_type  rule`` where rule is
  TL  lower(nullif(trim(x), ''))
  T   nullif(trim(x), '')
  C   cast only (no trim, no blank-to-NULL)
and the result is cast to the column's type. A cleaning model never filters,
joins or deduplicates: rows in = rows out, and it is a pure projection that
Catalyst fuses with the scan (column pruning reaches the Parquet reader).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from idloom.functions.casts import SPARK_TYPES, cast_to, check_not_floating, require_ansi, types_by_name
from idloom.functions.text import clean_lower, clean_text
from idloom.session import limit_methods

# Output columns, types and rules of the ten cleaning models.
_SPEC_TEXT = {
    "CREATORINFO": """
tiktok_id varchar C
handle_name varchar TL
display_name varchar T
email_address varchar TL
creator_ec_access_level number C
followers number C
ec_level varchar T
pqp float C
mcn_name varchar T
top_product_1_id number C
top_product_1_name varchar T
top_product_2_id number C
top_product_2_name varchar T
top_product_3_id number C
top_product_3_name varchar T
top_category_1_id number C
top_category_1_name varchar T
top_category_1_revenue_percentage float C
top_category_2_id number C
top_category_2_name varchar T
top_category_2_revenue_percentage float C
top_category_3_id number C
top_category_3_name varchar T
top_category_3_revenue_percentage float C
code number C
create_date timestamp_ntz C
last_update timestamp_ntz C
""",
    "CRMCREATOR": """
handle_name varchar TL
creator_id varchar C
display_name varchar T
followers number C
category1_name varchar T
category1_id number C
category2_name varchar T
category2_id number C
category3_name varchar T
category3_id number C
code number C
create_date timestamp_ntz C
last_update timestamp_ntz C
""",
    "HYDRATE": """
handle_name varchar TL
tiktok_id varchar C
email_address varchar TL
acct_create date C
sec_id varchar T
handle_modify date C
is_tts boolean C
language varchar T
is_commerce boolean C
category varchar T
fan_cnt number C
follow_cnt number C
like_cnt number C
vid_cnt number C
share_cnt number C
friend_cnt number C
code number C
create_date timestamp_ntz C
last_update timestamp_ntz C
""",
    "MARKET": """
tiktok_id varchar C
handle_name varchar TL
display_name varchar T
email_address varchar TL
selectionRegion varchar T
followerCount number C
promotedProductNum number C
brandCollaborationCount number C
avgCommissionRate float C
avgCommissionRateRange_min float C
avgCommissionRateRange_max float C
avgEcLiveCommentCount number C
avgEcLiveLikeCount number C
avgEcLiveShareCount number C
avgEcLiveViewCount number C
avgEcVideoCommentCount number C
avgEcVideoLikeCount number C
avgEcVideoPlayCount number C
avgEcVideoShareCount number C
avgGmvPerBuyer_amount float C
avgGmvPerBuyerRange_min float C
avgGmvPerBuyerRange_max float C
gmv_amount float C
gmvRange_min float C
gmvRange_max float C
gpm_amount float C
gpmRange_min float C
gpmRange_max float C
liveGmv_amount float C
liveGpm_amount float C
liveGpmRange_min float C
liveGpmRange_max float C
videoGmv_amount float C
videoGpm_amount float C
videoGpmRange_min float C
videoGpmRange_max float C
productOriginalPriceRange_min float C
productOriginalPriceRange_max float C
unitsSold number C
unitsSoldRange_min number C
unitsSoldRange_max number C
ecLiveCount number C
ecVideoCount number C
ecLiveEngagementRate float C
categoryId1 number C
categoryId2 number C
categoryId3 number C
categoryGmv1_id number C
categoryGmv1_value float C
categoryGmv2_id number C
categoryGmv2_value float C
categoryGmv3_id number C
categoryGmv3_value float C
categoryGmv4_id number C
categoryGmv4_value float C
contentGmvDistribution1_type varchar T
contentGmvDistribution1_value float C
contentGmvDistribution2_type varchar T
contentGmvDistribution2_value float C
contentGmvDistribution3_type varchar T
contentGmvDistribution3_value float C
topBrand1 number C
topBrand2 number C
topBrand3 number C
topBrand4 number C
topBrand5 number C
topBrand6 number C
topBrand7 number C
topBrand8 number C
topBrand9 number C
topBrand10 number C
code number C
create_date timestamp_ntz C
last_update timestamp_ntz C
""",
    "SEARCHINFO": """
handle_name varchar TL
display_name varchar T
selectionRegion varchar T
avgEcLiveUv number C
avgEcVideoViewCount number C
followerCount number C
gmv_amount float C
gmvRange_minimumAmount float C
gmvRange_maximumAmount float C
liveGmv_amount float C
videoGmv_amount float C
unitsSoldRange_minimumAmount number C
unitsSoldRange_maximumAmount number C
categoryIds_1 number C
categoryIds_2 number C
categoryIds_3 number C
topFollowerDemographics_majorGender_gender varchar T
topFollowerDemographics_majorGender_percentage number C
create_date timestamp_ntz C
last_update timestamp_ntz C
""",
    "BRAVO_V1": """
handle_name varchar TL
tiktok_id varchar C
created_at timestamp_ntz C
updated_at timestamp_ntz C
email varchar TL
other_fixed_traits varchar T
primary_content_categories varchar T
age_presentation varchar T
script_creativity varchar T
branding_integration varchar T
call_to_actions varchar T
pacing varchar T
storytelling_structure varchar T
charisma_authenticity varchar T
relatability varchar T
luxury_presentation varchar T
real_life_contexts varchar T
tiktok_native_effects varchar T
scarcity_urgency varchar T
authority_trust_building varchar T
adoption_of_trends varchar T
seasonal_cultural_relevance varchar T
""",
    "BRAVO_V2": """
handle_name varchar TL
tiktok_id varchar C
bio_description varchar T
bio_link varchar T
video_urls varchar T
created_at timestamp_ntz C
updated_at timestamp_ntz C
email varchar TL
unique_qualities varchar T
video_background varchar T
persona_archetype varchar T
lifestyle_alignment varchar T
video_contents varchar T
face_visibility varchar T
languages varchar T
primary_content_categories varchar T
gender_presentation varchar T
race_presentation varchar T
body_type varchar T
economic_status varchar T
age_presentation varchar T
overall_tone varchar T
video_quality varchar T
demonstration_style varchar T
hashtags varchar T
energy_level varchar T
authenticity_level varchar T
content_creator_type varchar T
detailed_appearance varchar T
personality_indicators varchar T
communication_style varchar T
content_format_specifics varchar T
lifestyle_details varchar T
product_interaction_approach varchar T
niche_specializations varchar T
products_promoted varchar T
creator_open_id varchar T
""",
    "ECHO": """
handle_name varchar TL
bio varchar T
bio_url varchar T
creator_id varchar C
follower_count number C
email varchar TL
follower_ages varchar T
follower_genders varchar T
follower_locations varchar T
follower_trend varchar T
gmv_trend varchar T
units_sold_trend varchar T
video_views_trend varchar T
video_engagement_trend varchar T
shoppable_video_views_trend varchar T
shoppable_video_engagement_trend varchar T
hashtags varchar T
videos varchar T
similar_creators_ids varchar T
created_time timestamp_ntz C
last_updated_time timestamp_ntz C
gender varchar T
language varchar T
tiktok_id varchar C
ig_follower_count number C
creator_summary_texts varchar T
gmv_30d_num_history varchar T
is_discord_creator varchar T
fts varchar T
ethnicity varchar T
""",
    "ADDRESS_PHONE": """
data_id number C
handle_name varchar C
first_last varchar C
phone_number varchar C
country varchar C
state varchar C
city varchar C
zipcode varchar C
address_1 varchar C
address_2 varchar C
""",
    "ZIP_LAT_LON": """
zipcode varchar C
latitude float C
longitude float C
""",
}

# Id columns: text identifiers that must not arrive as floating point.
_ID_COLUMNS = {"tiktok_id", "creator_id", "data_id", "creator_open_id", "sec_id"}


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    wtype: str
    rule: str

    @property
    def spark_type(self) -> str:
        return SPARK_TYPES[self.wtype]


@dataclass(frozen=True)
class StagingSpec:
    source: str
    columns: tuple

    @property
    def model_name(self) -> str:
        return "stg_" + self.source.lower()

    def names(self):
        return [c.name for c in self.columns]


def _parse(source: str, text: str) -> StagingSpec:
    cols = []
    for line in text.strip().splitlines():
        name, wtype, rule = line.split()
        if wtype not in SPARK_TYPES or rule not in ("C", "T", "TL"):
            raise ValueError(f"bad spec line {line!r}")
        cols.append(ColumnSpec(name, wtype, rule))
    return StagingSpec(source, tuple(cols))


SPECS: dict[str, StagingSpec] = {s: _parse(s, t) for s, t in _SPEC_TEXT.items()}


def column_expr(c: ColumnSpec, df: DataFrame, mode: str, blank_ids: bool = False) -> Column:
    if c.rule == "TL":
        x = clean_lower(c.name)
    elif c.rule == "T":
        x = clean_text(c.name)
    elif blank_ids and c.name in _ID_COLUMNS and c.wtype == "varchar":
        x = clean_text(c.name)
    else:
        x = F.col(c.name)
    raw_type = types_by_name(df)[c.name.lower()]
    if c.name in _ID_COLUMNS:
        check_not_floating(c.name, raw_type)
    return cast_to(x, c.wtype, mode, source_type=raw_type if c.rule == "C" else None).alias(c.name)


def apply_spec(df: DataFrame, spec: StagingSpec, mode: str = "strict",
               missing: str = "error", blank_ids: bool = False) -> DataFrame:
    """Project ``df`` through ``spec``: one ``select``, row count unchanged.

    ``missing`` decides what happens to spec columns the raw table lacks:
    "error" (default, as the warehouse would fail), "null" (typed NULL
    column), or "drop" (leave it out). Extra raw columns are always dropped.
    """
    require_ansi(df, mode)
    limit_methods(df.sparkSession)
    present = types_by_name(df)
    exprs = []
    for c in spec.columns:
        if c.name.lower() in present:
            exprs.append(column_expr(c, df, mode, blank_ids))
        elif missing == "null":
            exprs.append(F.lit(None).cast(c.spark_type).alias(c.name))
        elif missing == "drop":
            continue
        else:
            raise KeyError(f"{spec.source}: raw column {c.name!r} missing")
    return df.select(*exprs)


def clean_source(df: DataFrame, source: str, mode: str = "strict",
                 missing: str = "error", blank_ids: bool = False) -> DataFrame:
    return apply_spec(df, SPECS[source.upper()], mode, missing, blank_ids)
