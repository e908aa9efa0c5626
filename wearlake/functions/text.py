"""Keyword classifiers, instruction builder, text embedding and tokenizer as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: keyword lists in the order in which they decide
ACTIONS = {
    "pick_up": ["उठाओ", "उठाना", "pick", "lift", "grab", "लेना", "ले"],
    "put_down": ["रखो", "रखना", "place", "put", "drop", "रख"],
    "hand_over": ["दो", "देना", "give", "hand", "deliver", "सौंपना", "दे"],
    "open_door": ["खोलो", "खोलना", "open", "unlock", "खोल"],
    "close_door": ["बंद करो", "बंद", "close", "lock", "बंद कर"],
    "navigate": ["चलो", "जाओ", "go", "walk", "move", "जा", "चल", "आगे"],
    "driving": ["drive", "ड्राइव", "गाड़ी", "bike", "चलाओ"],
    "scan_barcode": ["scan", "स्कैन", "barcode", "qr"],
    "pay_collect": ["payment", "pay", "पैसे", "cash", "upi", "amount"],
    "idle": ["wait", "रुको", "stop", "रुक", "खड़े"],
}
SCENARIOS = {
    "food_delivery": ["delivery", "food", "खाना", "order", "restaurant", "deliver"],
    "quick_commerce": ["grocery", "groceries", "kirana", "warehouse", "pick", "pack", "scan"],
    "driving": ["drive", "road", "traffic", "signal", "turn", "lane"],
    "kitchen": ["cook", "kitchen", "खाना बनाना", "gas", "stove", "pan", "chop"],
    "warehouse": ["shelf", "rack", "box", "package", "sort", "inventory"],
}
# fixed values: instructions without a transcript (Hindi, English)
TEMPLATES = {
    "pick_up": ("वस्तु उठाओ", "Pick up the item"),
    "put_down": ("वस्तु रखो", "Put down the item"),
    "hand_over": ("सामान सौंपो", "Hand over the package"),
    "open_door": ("दरवाजा खोलो", "Open the door"),
    "close_door": ("दरवाजा बंद करो", "Close the door"),
    "navigate": ("आगे बढ़ो", "Navigate forward"),
    "driving": ("गाड़ी चलाओ", "Drive the vehicle"),
    "scan_barcode": ("बारकोड स्कैन करो", "Scan the barcode"),
    "pay_collect": ("पेमेंट लो", "Collect payment"),
    "idle": ("प्रतीक्षा करो", "Wait"),
}
DEFAULT_TEMPLATE = ("कार्य करो", "Perform task")
# fixed values: word swaps, applied one after the other
HINTS = [
    ("उठाओ", "pick up"), ("रखो", "put down"), ("दो", "give"), ("खोलो", "open"), ("बंद", "close"), ("चलो", "go"),
    ("स्कैन", "scan"), ("पैसे", "payment"), ("रुको", "wait"),
]
# fixed values: embedding vocabulary, in slot order
VOCABULARY = (
    "pick", "place", "carry", "deliver", "move", "push", "pull", "open", "close", "turn", "fold", "stack", "sort",
    "pour", "lift", "put", "take", "bring", "drop", "grab", "hold", "press", "switch", "scan", "pack", "unpack",
    "box", "bag", "bottle", "cup", "plate", "table", "chair", "door", "shelf", "drawer", "container", "item",
    "product", "package", "parcel", "food", "object", "tool", "button", "handle", "key", "phone", "book", "kitchen",
    "warehouse", "delivery", "office", "room", "counter", "floor", "wall", "aisle", "corridor", "entrance", "exit",
    "left", "right", "forward", "back", "up", "down", "inside", "outside", "near", "far", "robot", "human", "task",
    "action", "navigation", "manipulation", "grasp", "assembly", "inspection", "cleaning", "driving", "walking",
    "running", "sitting", "standing", "interact", "avoid", "detect", "search", "utha", "rakh", "le", "jao", "lao",
    "karo", "band", "kholo", "daal", "nikal", "pakar", "chalo", "ruko", "dhundho", "dena", "lena",
)
DIMENSIONS = 512
TOKEN = "[a-zA-Zऀ-ॿ]+"


def _first_match(text: Column, table: dict[str, list[str]]) -> Column:
    out = F
    for name, words in table.items():
        hit = F.lit(False)
        for w in words:
            hit = hit | text.contains(w)
        out = out.when(hit, name)
    return out


def action_word(lowered: Column) -> Column:
    """The first action with a keyword in a lower-case text, else null."""
    return _first_match(lowered, ACTIONS)


def scenario_word(lowered: Column) -> Column:
    """The first scenario with a keyword in a lower-case text, else null."""
    return _first_match(lowered, SCENARIOS)


def action(word: Column, motion: Column, stationary: Column) -> tuple[Column, Column]:
    """(action_type, confidence): the keyword's action, else from motion."""
    kind = F.coalesce(
        word, F.when(stationary, "idle").when(motion.isin("high", "medium"), "navigate").otherwise("other")
    )
    sure = F.when(word.isNotNull(), 0.85).when(stationary, 0.6).when(motion == "high", 0.5).when(
        motion == "medium", 0.4
    ).otherwise(0.3)
    return kind, sure


def scenario(word: Column, speed_kmh: Column, default: str) -> Column:
    """The keyword's scenario, else by the mean speed, else the default; a null speed means no GPS."""
    return F.coalesce(word, F.when(speed_kmh > 15, "driving").when(speed_kmh > 3, "food_delivery").otherwise(default))


def motion_level(magnitude: Column, frames: Column) -> tuple[Column, Column]:
    """(level, confidence) of a mean flow magnitude; under two frames low with 0.4, without a magnitude low with 0.3."""
    few = frames <= 1
    level = F.when(
        few | magnitude.isNull(), "low"
    ).when(magnitude > 8, "high").when(magnitude > 2, "medium").otherwise("low")
    return level, F.when(few, 0.4).when(
        magnitude.isNull(), 0.3
    ).when(magnitude > 8, 0.8).when(magnitude > 2, 0.7).otherwise(0.6)


def hint(text: Column, action_type: Column) -> Column:
    out = text
    for a, b in HINTS:
        out = F.replace(out, F.lit(a), F.lit(b))
    return F.when(out != text, out).otherwise(F.concat(F.lit("["), action_type, F.lit("]")))


def instructions(text: Column, action_type: Column) -> tuple[Column, Column]:
    """(Hindi, English): a text of over 3 characters and its hint, else the action's template."""
    pick = lambda k: F.coalesce(
        F.create_map(*(F.lit(x) for a, t in TEMPLATES.items() for x in (a, t[k])))[action_type],
        F.lit(DEFAULT_TEMPLATE[k]),
    )
    said = F.coalesce(F.length(text) > 3, F.lit(False))
    return F.when(said, text).otherwise(pick(0)), F.when(said, hint(text, action_type)).otherwise(pick(1))


def code_points(text: Column, length: int, modulus: int = 32_000) -> Column:
    """Code points modulo ``modulus`` of the first ``length`` characters, zero-padded."""
    text = F.coalesce(text, F.lit(""))
    return F.transform(
        F.sequence(F.lit(1), F.lit(length)),
        lambda j: F.when(
            j <= F.length(text), F.ascii(F.substring(text, j, F.lit(1))) % modulus
        ).otherwise(0).cast("long"),
    )


def attention_mask(text: Column, length: int) -> Column:
    """1 for each of the first ``length`` places that holds a character, else 0."""
    return F.transform(
        F.sequence(F.lit(1), F.lit(length)), lambda j: (j <= F.length(F.coalesce(text, F.lit("")))).cast("long")
    )
