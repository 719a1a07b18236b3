# -*- coding: utf-8 -*-
"""Word lists, field lists, lookup tables and markers.

Results depend on these values, so they are kept here as plain data, in their
natural order, and nowhere else.
"""

# Host endings that close a registered domain. A dot inside an
# entry is used as a regular-expression dot (any character), on purpose.
DOMAIN_ENDINGS = (
    "com.cn|com.mo|com.ph|com.pk|com.au|com.sg|co.za|ne.jp|net.cn|org.cn|gov.cn|gov.ru|"
    "lastampa.it|intoday.in|com|sg|net|cn|org|gov|cc|it|vn|co|me|tel|mobi|asia|biz|info|name|"
    "tv|hk|in|ca|tj|xin|ltd|store|vip|mom|game|lol|work|pub|club|xyz|top|ren|bid|loan|red|win|"
    "link|wang|date|party|site|online|tech|website|space|live|studio|press|news|video|click|"
    "trade|science|wiki|design|pics|photo|help|gift|rocks|band|market|software|social|lawyer|"
    "engineer|so|公司|中国|网络"
)

# The longer list used for pages from abroad.
DOMAIN_ENDINGS_ABROAD = (
    "com.cn|com.mo|com.ph|com.pk|com.au|com.sg|co.za|co.uk|ne.jp|net.cn|org.cn|gov.cn|gov.ru|"
    "lastampa.it|intoday.in|com|sg|net|cn|org|gov|cc|it|vn|co|me|tel|mobi|asia|biz|info|name|"
    "tv|hk|in|ca|tj|xin|ltd|store|vip|mom|game|lol|work|pub|club|xyz|top|ren|bid|loan|red|win|"
    "link|wang|date|party|site|online|tech|website|space|live|studio|press|news|video|click|"
    "trade|science|wiki|design|pics|photo|help|gift|rocks|band|market|software|social|lawyer|"
    "engineer|so|ru|am|公司|中国|网络"
)

# Texts stored instead of a domain.
DOMAIN_NOT_FOUND = "根据规则未发现一二级域名"
DOMAIN_BAD_URL = "一二级域名解析有误"

# Markers and defaults.
REPLY_SEPARATOR = "|||"
EMPTY_TITLE = "0^A"
EPOCH_TEXT = "1970-01-01 00:00:00"
WECHAT_URL = "http://mp.weixin.qq.com"
SNAPSHOT = "snapshot"

# Id of a search engine and its display name.
ENGINE_NAMES = {
    "1": "百度",
    "2": "360搜索",
    "3": "搜狗",
    "4": "中国搜索",
    "5": "中搜",
    "6": "天涯社区",
    "7": "凯迪社区",
    "8": "必应",
    "9": "红网",
    "10": "西祠",
    "11": "强国论坛",
    "12": "新华社区",
    "13": "中新搜索",
    "14": "新浪搜索",
    "15": "博客中国",
    "16": "腾讯博客",
    "17": "必应(英文)",
    "18": "谷歌",
    "19": "谷歌(英文)",
    "20": "雅虎(英文)",
    "21": "Rambler(俄文)",
}

# Search type and the group it belongs to.
SEARCH_TYPE_GROUPS = {"0": "1", "1": "2", "2": "0", "3": "11", "4": "3", "5": "4"}

# Declared fields per kind of message.
FORUM_FIELDS = tuple(
    "Id author click content domain_1 domain_2 gathertime group_id inserttime publishtime reply "
    "replycontent reposts_count site_id site_name site_url title url urlhash".split()
)
METASEARCH_FIELDS = tuple(
    "author click content domain_1 domain_2 gathertime group_id id inserttime metasearch otherInfo "
    "publishtime reply sengine sim_id site_id source stype summary tendency title url urlhash "
    "snapshot".split()
)
METASEARCH_PAD_FIELDS = tuple("content click reply author tendency sim_id snapshot".split())
WEBPAGE_FIELDS = tuple(
    "site_id site_name site_url title summary content url urlhash click reply source area "
    "publishtime gathertime inserttime author tendency sim_id snapshot".split()
)
PAPER_FIELDS = tuple(
    "site_id site_name site_url group_id title content url urlhash publishtime gathertime "
    "inserttime author sim_id snapshot".split()
)
WEIBO_FIELDS = tuple(
    "id aid created_at mid text source source_type geo user retweeted_status reposts_count "
    "comments_count attitudes_count thumbnail_pic original_pic attribute gathertime inserttime "
    "screen_name url pid keywords snapshot tendency sim_id".split()
)
WEIBOUSER_FIELDS = tuple(
    "id aid screen_name name province city description location url profile_image_url "
    "cover_image_phone gender domain followers_count friends_count statuses_count "
    "pagefriends_count bi_followers_count favourites_count following allow_all_act_msg "
    "allow_all_comment geo_enabled remark avatar_large avatar_hd verified verified_type "
    "verified_contact_email verified_contact_mobile verified_contact_name verified_level "
    "verified_state verified_reason verified_reason_modified verified_reason_url verified_trade "
    "verified_source verified_source_url follow_me mbtype mbrank level extend badge badge_top "
    "created_at credit_score lang star type containerid attribute gathertime inserttime".split()
)
YIXING_FIELDS = tuple(
    "group_id layer click tendency site_name url content inserttime urlhash title source "
    "publishtime gathertime reply".split()
)
# Columns of the first direct job; author and sim_id only when not blank.
FIRST_JOB_FIELDS = tuple(
    "site_id site_name site_url group_id title content url gathertime inserttime snapshot".split()
)
FIRST_JOB_OPTIONAL_FIELDS = ("author", "sim_id")
# Columns copied by the re-key job.
REKEY_FIELDS = tuple(
    "content gathertime inserttime site_id site_name site_url title url".split()
)
# Columns of a website document.
WEBSITE_TEXT_FIELDS = tuple(
    "site_id site_url summary urlhash click reply source area author tendency sim_id url".split()
)

# Patterns of the website and access-log jobs.
PUBLISH_TIME_PATTERN = (
    r"((20[0-3][0-9]-(0[13578]|1[02])-(0[1-9]|[12][0-9]|3[01]))"
    r"|(20[0-3][0-9]-(0[2469]|11)-(0[1-9]|[12][0-9]|30)))"
    r" (20|21|22|23|[0-1][0-9]):[0-5][0-9]:[0-5][0-9]"
)
LOG_ITEM_URL_PATTERN = r"http://www.ihaha.com/\d{4}-\d{2}-\d{2}/\d{9}.html"
LOG_TYPE_URL_PATTERN = r"http://www.chexun.com/\d{4}-\d{2}-\d{2}/\d{9}.html"
LOG_CATEGORY_PATTERN = r"100000726;100000730;\d{9};\d{9}"

# Fields of a subscription, in the order of its table.
SUBSCRIPTION_FIELDS = (
    "sub_id sp_id location_id prov_id city_code interv available start_time end_time "
    "center_longitude center_latitude radius shape"
).split()

# Pages of access-log lines, of the two sites that have rules and of another.
LOG_PAGES = (
    "http://www.chexun.com/2016-11-24/123456789.html",
    "http://www.ihaha.com/2016-11-24/123456789.html",
    "http://www.example.com/",
)
