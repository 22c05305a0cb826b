"""Fixed values of the data model: columns, types, keys, defaults, states and names."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import types as T

# --- Fixed values: stored columns of the three drop kinds, in load order, with types. ---

METADATA_COLUMNS = """
meta_id string, year int, month int, date int, poi_id string, duetinfo_duetfromid string,
meta_createtime bigint, meta_scheduletime bigint, meta_itemcommentstatus bigint,
meta_diversificationid string, meta_categorytype bigint, meta_textlanguage string,
meta_desc string, meta_locationcreated string, meta_diversificationlabels string,
meta_serverabversions string, meta_suggestedwords string, meta_adlabelversion string,
meta_bainfo string, meta_secret boolean, meta_privateitem boolean, meta_duetenabled boolean,
meta_stitchenabled boolean, meta_indexenabled boolean, meta_iscontentclassified boolean,
meta_isaigc boolean, meta_isad boolean, meta_isecvideo boolean, meta_aigclabeltype string,
meta_aigcdescription string, author_id string, author_uniqueid string, author_nickname string,
author_signature string, author_roomid string, author_verified boolean,
author_openfavorite boolean, author_commentsetting bigint, author_duetsetting bigint,
author_stitchsetting bigint, author_downloadsetting bigint, author_createtime bigint,
authorstats_followercount bigint, authorstats_followingcount bigint, authorstats_heart bigint,
authorstats_heartcount bigint, authorstats_videocount bigint, authorstats_diggcount bigint,
authorstats_friendcount bigint, music_id string, music_title string, music_authorname string,
music_album string, music_duration bigint, music_schedulesearchtime bigint,
music_collected boolean, stats_diggcount bigint, stats_sharecount bigint,
stats_commentcount bigint, stats_playcount bigint, stats_collectcount bigint,
video_height bigint, video_width bigint, video_duration bigint, video_bitrate bigint,
video_ratio string, video_encodedtype string, video_format string, video_videoquality string,
video_codectype string, video_definition string, poi_type string, poi_name string,
poi_address string, poi_city string, poi_citycode string, poi_province string,
poi_country string, poi_countrycode string, poi_fatherpoiid string, poi_fatherpoiname string,
poi_category string, poi_tttypecode string, poi_typecode string, poi_tttypenametiny string,
poi_tttypenamemedium string, poi_tttypenamesuper string, adress_addresscountry string,
adress_addresslocality string, adress_addressregion string, adress_streetaddress string,
statuscode bigint, statusmsg string, description_hash string, subtitle_subtitle_lang string,
bitrate_bitrate_info string, text_extra_user_mention string,
text_extra_hashtag_mention string, warning_warning string, timestamp bigint, pol string,
hour bigint, country string, processed_desc string, raw string, collection_timestamp bigint
"""

COMMENT_COLUMNS = """
meta_id string, year int, month int, date int, cid string, aweme_id string,
comment_text string, create_time bigint, digg_count bigint, reply_comment_total bigint,
comment_language string, status bigint, stick_position bigint,
is_comment_translatable boolean, no_show boolean, user_digged boolean, user_buried boolean,
is_author_digged boolean, author_pin boolean, reply_id string, reply_to_reply_id string,
reply_comment string, reply_score decimal(5,2), show_more_score decimal(5,2), uid string,
sec_uid string, nickname string, unique_id string, custom_verify string,
enterprise_verify_reason string, account_labels string, label_list string, sort_tags string,
comment_post_item_ids string, collect_stat string, ad_cover_url string,
advance_feature_item_order string, advanced_feature_info string, bold_fields string,
can_message_follow_status_list string, can_set_geofencing string, cha_list string,
cover_url string, events string, followers_detail string, geofencing string,
homepage_bottom_toast string, item_list string, mutual_relation_avatars string,
need_points string, platform_sync_info string, relative_users string,
search_highlight string, shield_edit_field_info string, type_label string,
user_profile_guide string, user_tags string, white_cover_url string, total bigint,
collection_timestamp bigint, hash_unique_id string
"""

SUBTITLE_COLUMNS = """
meta_id string, year int, month int, date int, content string, lang string, type string,
rest string, collection_timestamp bigint, hash_unique_id string
"""

# 0/1/null columns that become booleans.
METADATA_FLAGS = [
    "meta_secret", "meta_privateitem", "meta_duetenabled", "meta_stitchenabled",
    "meta_indexenabled", "meta_iscontentclassified", "meta_isaigc", "meta_isad",
    "meta_isecvideo", "author_verified", "author_openfavorite", "music_collected",
]
COMMENT_FLAGS = [
    "is_comment_translatable", "no_show", "user_digged", "user_buried",
    "is_author_digged", "author_pin", "music_collected",
]

# What a column holds when an insert does not name it.
METADATA_DEFAULTS = {
    "meta_secret": False, "meta_privateitem": False, "meta_duetenabled": True,
    "meta_stitchenabled": True, "meta_indexenabled": True, "meta_iscontentclassified": False,
    "meta_isaigc": False, "meta_isad": False, "meta_isecvideo": False,
    "author_verified": False, "author_openfavorite": True,
    "authorstats_followercount": 0, "authorstats_followingcount": 0, "authorstats_heart": 0,
    "authorstats_heartcount": 0, "authorstats_videocount": 0, "authorstats_diggcount": 0,
    "authorstats_friendcount": 0, "music_collected": False,
    "stats_diggcount": 0, "stats_sharecount": 0, "stats_commentcount": 0,
    "stats_playcount": 0, "stats_collectcount": 0,
}
COMMENT_DEFAULTS = {
    "digg_count": 0, "reply_count": 0, "reply_comment_total": 0,
    "is_comment_translatable": False, "no_show": False, "user_digged": False,
    "user_buried": False, "is_author_digged": False, "author_pin": False,
}
QUEUE_DEFAULTS = {"status": "pending"}

# Queue and worker states.
STATUSES = [
    "pending", "transferring", "ready_to_process", "transfer_failed",
    "processing", "completed", "processing_failed", "completed_with_errors",
]
RUNNING_STATUSES = ["transferring", "processing"]
FINAL_STATUSES = ["completed", "processing_failed", "completed_with_errors"]
WORKER_FAILED = ["FAILED", "CANCELLED", "TIMEOUT", "NODE_FAIL"]
WORKER_RUNNING = ["RUNNING", "PENDING", "CONFIGURING"]
WORKER_COMPLETED = ["COMPLETED"]

# Month names; abbreviations are the first three letters, and "sept".
MONTHS = [
    "january", "february", "march", "april", "may", "june",
    "july", "august", "september", "october", "november", "december",
]

DEFAULT_LOCATION = "zurich"
SAMPLES_PER_SECOND = 16000
ARRIVED_PERCENT = 90
ARCHIVES_PER_TASK = 12

DAY = ["year", "month", "date"]
BUSINESS_KEY = ["meta_id", *DAY]
COMMENT_KEY = ["cid", *BUSINESS_KEY]


class Kind:
    """One kind of drop: its name, stored columns, key, flags, defaults and renames."""

    def __init__(self, name, columns, key, flags=(), defaults=None, renames=None, stored=""):
        self.name = name
        self.ddl = columns.strip()
        self.stored = stored
        self.key = list(key)
        self.flags = list(flags)
        self.defaults = dict(defaults or {})
        self.renames = dict(renames or {})

    @cached_property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.ddl)

    @cached_property
    def scan_types(self) -> dict[str, T.DataType]:
        """Stored types by the names columns have in drops. Flags keep their own type until they
        are made booleans, and the day comes from the file name."""
        raw = {b: a for a, b in self.renames.items()}
        return {
            raw.get(f.name, f.name): f.dataType for f in self.schema.fields
            if f.name not in self.flags and f.name not in DAY
        }

    @cached_property
    def table_schema(self) -> T.StructType:
        """The stored table: an id, extra stored columns, the drop's columns and two times."""
        return T.StructType.fromDDL(
            f"id string, {self.stored}{self.ddl}, "
            "created_at timestamp_ntz, updated_at timestamp_ntz"
        )


KINDS = {
    "metadata": Kind(
        "metadata", METADATA_COLUMNS, BUSINESS_KEY, METADATA_FLAGS, METADATA_DEFAULTS,
        stored="audio_file_id string, ",
    ),
    # Raw comments call their text "text"; the stored column is "comment_text".
    "comments": Kind(
        "comments", COMMENT_COLUMNS, COMMENT_KEY, COMMENT_FLAGS, COMMENT_DEFAULTS,
        renames={"text": "comment_text"}, stored="reply_count bigint, ",
    ),
    "subtitles": Kind("subtitles", SUBTITLE_COLUMNS, BUSINESS_KEY),
}

# The English stop words that text search leaves out.
STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she
her hers herself it its itself they them their theirs themselves what which who whom this that
these those am is are was were be been being have has had having do does did doing a an the and
but if or because as until while of at by for with about against between into through during
before after above below to from up down in out on off over under again further then once here
there when where why how all any both each few more most other some such no nor not only own
same so than too very s t can will just don should now
""".split()
