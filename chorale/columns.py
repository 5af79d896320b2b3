"""Column names of the tables, which are the same everywhere in the package."""

USER = "user_id"
ITEM = "recording_msid"
TIME = "timestamp"
EVENT = "event_id"
PLAYS = "play_count"
ITEM_INDEX = "track_id_index"
USER_INDEX = "user_index"
POSITION = "pos"
IS_TRAIN = "is_train"
