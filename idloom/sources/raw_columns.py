"""The raw columns of each source by the form of their values, written out
apart from the cleaning specs: the adapters make them, the oracle SQL cleans
them by their form. A wrong name, type or rule on either side is a difference.

Forms: ``varchar`` kept as it is; ``text`` trimmed, blank to NULL; ``lower`` the
same in lower case; ``number``, ``float``, ``timestamp``, ``date``, ``boolean``.
"""

from __future__ import annotations

# The sources' columns.
_TEXT = {
    "CREATORINFO": """
varchar: tiktok_id
lower: handle_name email_address
text: display_name ec_level mcn_name top_product_1_name top_product_2_name top_product_3_name
  top_category_1_name top_category_2_name top_category_3_name
number: creator_ec_access_level followers top_product_1_id top_product_2_id top_product_3_id top_category_1_id
  top_category_2_id top_category_3_id code
float: pqp top_category_1_revenue_percentage top_category_2_revenue_percentage
  top_category_3_revenue_percentage
timestamp: create_date last_update
""",
    "CRMCREATOR": """
lower: handle_name
varchar: creator_id
text: display_name category1_name category2_name category3_name
number: followers category1_id category2_id category3_id code
timestamp: create_date last_update
""",
    "HYDRATE": """
lower: handle_name email_address
varchar: tiktok_id
date: acct_create handle_modify
text: sec_id language category
boolean: is_tts is_commerce
number: fan_cnt follow_cnt like_cnt vid_cnt share_cnt friend_cnt code
timestamp: create_date last_update
""",
    "MARKET": """
varchar: tiktok_id
lower: handle_name email_address
text: display_name selectionRegion contentGmvDistribution1_type contentGmvDistribution2_type
  contentGmvDistribution3_type
number: followerCount promotedProductNum brandCollaborationCount avgEcLiveCommentCount avgEcLiveLikeCount
  avgEcLiveShareCount avgEcLiveViewCount avgEcVideoCommentCount avgEcVideoLikeCount avgEcVideoPlayCount
  avgEcVideoShareCount unitsSold unitsSoldRange_min unitsSoldRange_max ecLiveCount ecVideoCount categoryId1
  categoryId2 categoryId3 categoryGmv1_id categoryGmv2_id categoryGmv3_id categoryGmv4_id topBrand1 topBrand2
  topBrand3 topBrand4 topBrand5 topBrand6 topBrand7 topBrand8 topBrand9 topBrand10 code
float: avgCommissionRate avgCommissionRateRange_min avgCommissionRateRange_max avgGmvPerBuyer_amount
  avgGmvPerBuyerRange_min avgGmvPerBuyerRange_max gmv_amount gmvRange_min gmvRange_max gpm_amount gpmRange_min
  gpmRange_max liveGmv_amount liveGpm_amount liveGpmRange_min liveGpmRange_max videoGmv_amount videoGpm_amount
  videoGpmRange_min videoGpmRange_max productOriginalPriceRange_min productOriginalPriceRange_max
  ecLiveEngagementRate categoryGmv1_value categoryGmv2_value categoryGmv3_value categoryGmv4_value
  contentGmvDistribution1_value contentGmvDistribution2_value contentGmvDistribution3_value
timestamp: create_date last_update
""",
    "SEARCHINFO": """
lower: handle_name
text: display_name selectionRegion topFollowerDemographics_majorGender_gender
number: avgEcLiveUv avgEcVideoViewCount followerCount unitsSoldRange_minimumAmount
  unitsSoldRange_maximumAmount categoryIds_1 categoryIds_2 categoryIds_3
  topFollowerDemographics_majorGender_percentage
float: gmv_amount gmvRange_minimumAmount gmvRange_maximumAmount liveGmv_amount videoGmv_amount
timestamp: create_date last_update
""",
    "BRAVO_V1": """
lower: handle_name email
varchar: tiktok_id
timestamp: created_at updated_at
text: other_fixed_traits primary_content_categories age_presentation script_creativity branding_integration
  call_to_actions pacing storytelling_structure charisma_authenticity relatability luxury_presentation
  real_life_contexts tiktok_native_effects scarcity_urgency authority_trust_building adoption_of_trends
  seasonal_cultural_relevance
""",
    "BRAVO_V2": """
lower: handle_name email
varchar: tiktok_id
text: bio_description bio_link video_urls unique_qualities video_background persona_archetype
  lifestyle_alignment video_contents face_visibility languages primary_content_categories gender_presentation
  race_presentation body_type economic_status age_presentation overall_tone video_quality demonstration_style
  hashtags energy_level authenticity_level content_creator_type detailed_appearance personality_indicators
  communication_style content_format_specifics lifestyle_details product_interaction_approach
  niche_specializations products_promoted creator_open_id
timestamp: created_at updated_at
""",
    "ECHO": """
lower: handle_name email
text: bio bio_url follower_ages follower_genders follower_locations follower_trend gmv_trend units_sold_trend
  video_views_trend video_engagement_trend shoppable_video_views_trend shoppable_video_engagement_trend
  hashtags videos similar_creators_ids gender language creator_summary_texts gmv_30d_num_history
  is_discord_creator fts ethnicity
varchar: creator_id tiktok_id
number: follower_count ig_follower_count
timestamp: created_time last_updated_time
""",
    "ADDRESS_PHONE": """
number: data_id
varchar: handle_name first_last phone_number country state city zipcode address_1 address_2
""",
    "ZIP_LAT_LON": """
varchar: zipcode
float: latitude longitude
""",
}


def _parse(text: str) -> dict[str, str]:
    forms: dict[str, str] = {}
    form = ""
    for word in text.split():
        if word.endswith(":"):
            form = word[:-1]
        else:
            forms[word] = form
    return forms


#: {source: {column: form}}
RAW_COLUMNS: dict[str, dict[str, str]] = {source: _parse(text) for source, text in _TEXT.items()}
