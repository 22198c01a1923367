"""A small worked example: seven users, seven items, target user 1."""

INTERACTIONS = [
    (1, 10, True), (1, 11, False), (1, 13, True),
    (2, 10, True), (2, 11, True), (2, 11, True),
    (3, 12, True), (3, 14, True),
    (4, 15, True), (4, 11, True),
    (5, 15, True), (5, 11, True),
    (6, 16, True),
    (7, 10, None),
    (None, 10, True), (2, None, True),
]
ITEMS = [(10, "Alpha"), (11, "Beta"), (12, "Gamma"), (13, "Delta"), (15, "Eps"), (16, "Zeta")]
ITEM_TAGS = [
    (10, ["Action", " Free  To\tPlay "]),
    (11, ["action", "RPG"]),
    (12, ["Puzzle, Logic"]),
    (13, []),
    (14, ["RPG"]),
    (15, ["RPG", None, "Action"]),
    (16, None),
]
TARGET = 1


def tables(spark, key_type="int"):
    return (
        spark.createDataFrame(
            INTERACTIONS, f"user_id {key_type}, app_id {key_type}, is_recommended boolean"
        ),
        spark.createDataFrame(ITEMS, f"app_id {key_type}, title string"),
        spark.createDataFrame(ITEM_TAGS, f"app_id {key_type}, tags array<string>"),
    )
