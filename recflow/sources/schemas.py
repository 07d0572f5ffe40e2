"""The columns of the source tables. Ids are long; every field may be null."""

USERS = "uid long, username string, role string, province string, city string, district string"
ITEMS = (
    "id long, name string, description string, category string, price decimal(10,2), stock int, "
    "province string, city string, district string, image_url string, user_id long, "
    "user_type string, created_at timestamp, specific_attributes string"
)
EVENTS = (
    "event_id long, user_id long, item_id long, event_type string, timestamp date, "
    "page_depth int, current_url string"
)
TAGS = "tag_id string, tag_name string, tag_weight decimal(8,4), mark_object string, category_id int"
TAG_CATEGORIES = (
    "tag_category_id int, category_name string, category_parent_id int, level int"
)
ITEM_TAGS = "id long, item_id long, tag_id string, weight decimal(8,4)"
USER_TAGS = "id long, user_id long, tag_id string, weight decimal(8,4)"
FEED = "feed_id long, user_id long, item_id long, rec_algo string, timestamp date"
ITEM_SCORE = "item_id long, score double"
ACTION_MATRIX = "user_id long, item_id long, val double"
