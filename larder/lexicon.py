"""Word lists, patterns and tables that decide the results.

Every value here must stay exactly as it is for the results to be right, so
they are kept as plain text, in their natural order (order matters wherever the
first hit wins).  Word tests are lower-case substring tests unless a name says
otherwise.
"""


# --- line tests -----------------------------------------------------------
INGREDIENT_LINE_PATTERN = r"\d+(?:\.\d+)?(?:/\d+)?\s*[a-zA-Z]+\s+.+|\d+(?:\.\d+)?(?:/\d+)?\s+.+|[a-zA-Z]+\s+.+"
INGREDIENT_LINE_WORDS = ["cup", "tablespoon", "teaspoon", "pound", "ounce", "gram", "kg", "ml", "liter"]
INSTRUCTION_LINE_PATTERN = r"\d+\.\s*.+|Step\s+\d+:\s*.+|\d+\)\s*.+"
INSTRUCTION_LINE_WORDS = ["mix", "stir", "cook", "bake", "fry", "boil", "heat", "add", "remove", "serve"]

# --- title and description ------------------------------------------------
TITLE_PATTERNS = [
    r"(?dm)(?:^|\n)([A-Z][^.!?\n]{10,})(?:\n|$)",
    r"(?dm)(?:Recipe:|Title:)\s*(.+?)(?:\n|$)",
    r"\*\*([^*]+)\*\*",
]
DESCRIPTION_PATTERNS = [
    r"(?is)(?:Description:|About:)\s*(.+?)(?:\n\n|Ingredient|Direction|Method|Step)",
    r"(?is)(?:^|\n)([^*\n]{50,}?)(?:\n\n|\*\*Ingredient)",
]

# --- times and pan size (all case-insensitive, first hit wins) -------------
_DURATION = r"(\d+(?:\.\d+)?\s*(?:minute|hour|min|hr)s?)"
PREP_TIME_PATTERNS = [
    r"(?i)prep[aration]*\s+time:?\s*" + _DURATION,
    r"(?i)preparation:?\s*" + _DURATION,
]
COOK_TIME_PATTERNS = [
    r"(?i)cook[ing]*\s+time:?\s*" + _DURATION,
    r"(?i)cooking:?\s*" + _DURATION,
    r"(?i)bake\s+(?:for\s+)?" + _DURATION,
    r"(?i)total\s+cook\s+time:?\s*" + _DURATION,
]
CHILL_TIME_PATTERNS = [
    r"(?i)chill[ing]*\s+time:?\s*" + _DURATION,
    r"(?i)refrigerate\s+for\s+" + _DURATION,
    r"(?i)let\s+rest\s+for\s+" + _DURATION,
]
PAN_SIZE_PATTERNS = [
    r"(?i)(\d+x\d+\s*(?:inch|in|cm))",
    r"(?i)(\d+\s*(?:inch|in|cm)\s+pan)",
    r"(?i)(\d+\s*(?:quart|qt|liter|l)\s+pot)",
]

# --- difficulty -----------------------------------------------------------
DIFFICULTY_WORDS = {
    "easy": ["beginner", "simple", "quick", "easy"],
    "medium": ["intermediate", "medium"],
    "hard": ["advanced", "difficult", "hard", "complex", "challenging"],
}
ADVANCED_TECHNIQUES = [
    "sous vide", "tempering", "emulsify", "caramelize", "braise", "confit", "deglaze", "flambe", "reduce",
    "blanch", "score",
]
BULLET_COUNT_PATTERN = r"(?:^|\n)\s*[-*•]"
STEP_COUNT_PATTERN = r"(?:^|\n)\s*\d+[.)]"

# --- cuisine (order is the tie-break) --------------------------------------
CUISINE_WORDS = {
    "Italian": [
        "italian", "pasta", "risotto", "parmigiano", "parmesan", "mozzarella", "basil", "marinara",
        "carbonara", "lasagna", "tiramisu", "bruschetta",
    ],
    "Mexican": [
        "mexican", "taco", "burrito", "enchilada", "salsa", "guacamole", "tortilla", "cilantro", "jalapeño",
        "chipotle", "fajita", "quesadilla",
    ],
    "Chinese": [
        "chinese", "stir fry", "wok", "soy sauce", "ginger", "bok choy", "szechuan", "dim sum", "dumpling",
        "lo mein", "chow mein",
    ],
    "Japanese": [
        "japanese", "sushi", "ramen", "miso", "teriyaki", "tempura", "wasabi", "udon", "soba", "sake",
        "mirin", "nori",
    ],
    "Thai": [
        "thai", "pad thai", "curry paste", "lemongrass", "fish sauce", "coconut milk", "basil thai",
        "galangal", "kaffir lime",
    ],
    "Indian": [
        "indian", "curry", "naan", "tandoori", "masala", "tikka", "cumin", "turmeric", "garam masala",
        "cardamom", "biryani",
    ],
    "French": [
        "french", "béarnaise", "hollandaise", "croissant", "baguette", "coq au vin", "ratatouille", "crème",
        "bourguignon", "soufflé",
    ],
    "Greek": [
        "greek", "feta", "tzatziki", "gyro", "moussaka", "baklava", "oregano", "kalamata", "spanakopita",
        "souvlaki",
    ],
    "Korean": [
        "korean", "kimchi", "bibimbap", "bulgogi", "gochujang", "ssamjang", "korean bbq", "banchan",
        "gochugaru", "soju",
    ],
    "Vietnamese": ["vietnamese", "pho", "banh mi", "spring roll", "nuoc mam"],
    "Spanish": ["spanish", "paella", "tapas", "chorizo", "gazpacho", "sangria"],
    "American": [
        "bbq", "barbecue", "burger", "hotdog", "mac and cheese", "southern", "cajun", "creole",
        "fried chicken",
    ],
    "Middle Eastern": [
        "middle eastern", "hummus", "falafel", "tahini", "shawarma", "pita", "chickpea", "couscous", "kebab",
        "baba ganoush",
    ],
    "Mediterranean": ["mediterranean", "olive oil", "feta", "olives", "lemon"],
}

# --- meal type (order is the tie-break) ------------------------------------
MEAL_WORDS = {
    "breakfast": [
        "breakfast", "pancake", "waffle", "omelette", "omelet", "french toast", "cereal", "granola", "muffin",
        "bagel", "croissant", "eggs benedict", "breakfast burrito", "brunch", "morning",
    ],
    "lunch": ["lunch", "sandwich", "wrap", "salad", "soup and salad", "midday"],
    "dinner": [
        "dinner", "supper", "main course", "entrée", "entree", "evening meal", "brat", "bratwurst", "sausage",
        "steak", "chops", "roast", "burger", "gravy", "pasta", "chicken", "beef", "pork", "fish",
    ],
    "dessert": [
        "dessert", "cake", "cookie", "brownie", "pie", "tart", "pudding", "ice cream", "sorbet", "mousse",
        "truffle", "candy", "sweet", "frosting", "cheesecake", "cupcake", "macaron", "tiramisu", "parfait",
        "fudge",
    ],
    "snack": [
        "snack", "appetizer", "finger food", "dip", "chips", "popcorn", "energy ball", "trail mix", "tapas",
        "mezze",
    ],
}
SWEET_WORDS = ["sugar", "chocolate", "cocoa", "honey", "maple syrup", "vanilla extract"]
SAVOURY_WORDS = ["chicken", "beef", "pork", "fish", "meat", "pasta"]

# --- dietary tags (order is the output order) -------------------------------
TAG_WORDS = {
    "vegetarian": ["vegetarian", "veggie"],
    "vegan": ["vegan", "plant-based", "plant based"],
    "gluten-free": ["gluten-free", "gluten free", "gf "],
    "dairy-free": ["dairy-free", "dairy free", "lactose-free"],
    "keto": ["keto", "ketogenic", "low-carb", "low carb"],
    "paleo": ["paleo", "paleolithic"],
    "whole30": ["whole30", "whole 30"],
    "low-fat": ["low-fat", "low fat", "fat-free"],
    "sugar-free": ["sugar-free", "sugar free", "no sugar"],
    "nut-free": ["nut-free", "nut free"],
    "soy-free": ["soy-free", "soy free"],
    "kosher": ["kosher"],
    "halal": ["halal"],
}
MEAT_WORDS = [
    "chicken", "beef", "pork", "fish", "meat", "bacon", "sausage", "turkey", "lamb", "duck", "seafood",
    "shrimp", "salmon",
]
DAIRY_WORDS = ["milk", "cheese", "butter", "cream", "yogurt", "whey"]
EGG_WORDS = ["egg"]

# --- sections ---------------------------------------------------------------
INGREDIENT_SECTION_PATTERN = (
    r"(?is)(?:\*\*)?Ingredients?(?:\*\*)?:?\s*(.*?)"
    r"(?=(?:\*\*)?(?:Instructions?|Directions?|Method|Steps?|Preparation)(?:\*\*)?:|\z)"
)
INSTRUCTION_SECTION_PATTERN = (
    r"(?is)(?:\*\*)?(?:Instructions?|Directions?|Method|Steps?)(?:\*\*)?:?\s*(.*)\z"
)
INGREDIENT_START_WORDS = ["ingredient", "what you need", "you will need", "shopping list"]
INGREDIENT_END_WORDS = ["instruction", "direction", "method", "step", "preparation"]
INSTRUCTION_START_WORDS = ["instruction", "direction", "method", "step", "preparation", "how to"]
SECTION_TITLE_ITEMS = ["ingredients", "ingredient list", "what you need"]
STEP_TITLE_ITEMS = ["instructions", "directions", "method", "steps"]
VIDEO_LINE_STARTS = ["video recipe is", "(video", "recipe video"]

# --- ingredient line parsing --------------------------------------------------
SERVES_PATTERN = r"^\(serves?\s+\d+\)"
FOR_HEADER_QUANTITY_WORDS = ["cup", "tbsp", "tsp", "oz", "lb", "gram", "ml", "liter"]
LINE_NOTES = ["to taste", "optional", "as needed", "if desired"]
SMART_NOTES = ["(optional)", "optional", "to taste", "as needed", "if desired"]
STANDALONE_NOTES = ["to taste", "optional", "as needed", "if desired", "(optional)", "for garnish"]
GROUP_HEADER_WORDS = [
    "dough", "sauce", "topping", "garnish", "marinade", "filling", "crust", "batter", "glaze", "syrup",
    "broth", "base", "layer",
]
STEP_HEADER_WORDS = ["preparation", "instructions", "method", "steps", "directions"]
SMART_VERBS = [
    "coat", "sift", "strain", "cook", "add", "mix", "stir", "deglaze", "fix", "serve", "place", "heat",
    "pour", "bring", "reduce", "simmer", "bake", "remove", "set", "cover", "wait", "let", "transfer",
    "combine", "whisk", "beat", "fold", "knead", "roll", "cut", "chop", "slice", "dice", "fill", "toss",
]
BAD_FIRST_WORDS = [
    "coat", "sift", "strain", "fill", "toss", "serve", "mix", "stir", "cook", "bake", "heat", "pour", "bring",
    "combine", "transfer", "place", "remove", "set", "cover", "let", "allow", "preheat", "add", "blend",
    "whisk", "beat", "fold",
]
# tried in this order; the first that matches and leaves an item of 2+ characters wins
QUANTITY_ALTERNATIVE_PATTERN = r"(?di)^([\d/\-\.x]+)\s+([a-zA-Z]+)\s*\([^)]+\)\s+(.+)$"
TRAILING_AMOUNT_PATTERN = r"(?di)^(.+?)\s*\(([^)]+)\).*$"
QUANTITY_UNIT_PATTERN = r"(?di)^([\d/\-\.]+)\s+([a-zA-Z]+)\s+(.+)$"
ABOUT_QUANTITY_PATTERN = (
    r"(?di)^(?:about|approx|approximately)?\s*([\d/\-\.]+)\s+([a-zA-Z]+)\s+(?:worth of\s+)?(.+)$"
)
QUANTITY_ONLY_PATTERN = r"(?di)^([\d/\-\.]+)\s+(.+)$"
STANDARD_UNITS = [
    "cup", "cups", "c", "tbsp", "tsp", "tablespoon", "tablespoons", "teaspoon", "teaspoons", "oz", "ounce",
    "ounces", "lb", "lbs", "pound", "pounds", "g", "gram", "grams", "kg", "kilogram", "kilograms", "ml",
    "milliliter", "milliliters", "l", "liter", "liters", "quart", "quarts", "qt", "pint", "pints", "pt",
    "gallon", "gallons", "gal", "clove", "cloves", "piece", "pieces", "slice", "slices", "can", "cans", "jar",
    "jars", "package", "packages", "pkg", "bunch", "bunches", "head", "heads", "stalk", "stalks", "sprig",
    "sprigs", "pinch", "dash",
]
LINE_PATTERN = r"(?d)^([\d\s/\-\.]+)?\s*([a-zA-Z]+)?\s+(.+)$"
LINE_UNITS = [
    "cup", "cups", "tbsp", "tsp", "tablespoon", "teaspoon", "oz", "lb", "g", "kg", "ml", "l", "pound",
    "ounce",
]
SIMPLE_LINE_PATTERN = r"(?d)^([\d\s/\-\.]+(?:\s*[a-zA-Z]+)?)\s+(.+)$"
LENIENT_MEASURE_PATTERN = (
    r"(?i)\d|\bcup|tbsp|tsp|tablespoon|teaspoon|ounce|oz|pound|lb|gram|g|kg|ml|liter|l\b"
)
LENIENT_SKIP_STARTS = ["ingredients:", "instructions:", "directions:", "step", "method"]
LISTED_UNIT_PATTERN = r"(?d)^(\d+(?:\.\d+)?(?:/\d+)?)\s*([a-zA-Z]+)\s+(.+)$"
LISTED_QUANTITY_PATTERN = r"(?d)^(\d+(?:\.\d+)?(?:/\d+)?)\s+(.+)$"

# --- instruction line parsing -------------------------------------------------
STEP_VERBS = [
    "mix", "stir", "cook", "bake", "fry", "boil", "heat", "add", "remove", "serve", "combine", "whisk",
    "pour", "place", "put", "cut", "chop", "dice", "slice", "preheat", "prepare", "spread", "fold", "blend",
    "process",
]
LENIENT_STEP_VERBS = [
    "mix", "stir", "cook", "bake", "fry", "boil", "heat", "add", "remove", "combine", "whisk", "prepare",
    "place", "serve", "preheat", "pour",
]
LENIENT_STEP_SKIP_STARTS = ["ingredients:", "instructions:", "directions:"]

# --- placeholders ---------------------------------------------------------------
UNTITLED = "Untitled Recipe"
NO_INGREDIENTS_ITEM, NO_INGREDIENTS_AMOUNT = "Ingredients listed in recipe text", "See recipe"
NO_STEPS_TITLE, NO_STEPS_TEXT = "Preparation", "See full recipe text for instructions"

# --- clean-up of model output ------------------------------------------------------
MODEL_VERBS = [
    "cook", "add", "mix", "stir", "deglaze", "fix", "serve", "place", "heat", "pour", "bring", "reduce",
    "simmer", "bake", "remove", "set", "cover", "wait", "let", "transfer", "combine",
]
MODEL_HEADERS = ["**preparation", "**instructions", "**method", "**steps"]
MODEL_UNITS = ["cup", "cups", "tbsp", "tsp", "oz", "g", "kg", "ml", "l"]
MODEL_SWAP_PATTERN = (
    r"(?di)^(\d+(?:/\d+)?(?:st|nd|rd|th)?\s*(?:cups?|tbsp?|tsp?|oz|g|kg|ml|l|cloves?|pieces?)?)\s+(.+)$"
)
MODEL_AMOUNT_PATTERN = r"(?d)^(\d+(?:\.\d+)?(?:/\d+)?)\s+(.+)$"
PREP_VERBS = ["cut", "chopped", "diced", "minced", "sliced", "grated", "shredded", "peeled", "finely"]
MAIN_COURSE_WORDS = [
    "brat", "sausage", "chicken", "beef", "pork", "fish", "pasta", "steak", "chops", "roast", "burger",
    "gravy",
]
DESSERT_WORDS = [
    "cake", "cookie", "brownie", "pie", "ice cream", "chocolate", "frosting", "icing", "candy", "fudge",
    "tart", "pudding",
]

# --- post selection ------------------------------------------------------------------
SELF_POST_WORDS = ["ingredients", "instructions", "preparation", "prep time", "cook time", "servings"]
COMMENT_WORDS = SELF_POST_WORDS + ["total time"]

# --- loading --------------------------------------------------------------------------
NULL_TOKENS = ["<UNKNOWN>", "null", ""]
DIFFICULTIES = ["easy", "medium", "hard"]
MEAL_TYPES = ["breakfast", "lunch", "dinner", "snack", "dessert"]
MEAL_TYPE_ALIASES = {
    "side dish": "snack",
    "side": "snack",
    "soup": "lunch",
    "appetizer": "snack",
    "beverage": "snack",
    "drink": "snack",
}
UNIT_TYPES = ["volume", "weight", "count", "length", "temperature", "other"]
LOAD_SKIP_WORDS = [
    "how to do it", "directions*", "instructions",
    "preheat", "in the meantime", "cooking the", "bake at", "bake for", "blend everything", "transfer to",
    "mix the", "place the", "pour the", "take the", "add the", "remove from", "set aside", "let sit",
    "let it rest", "allow it to", "continue cooking", "reduce heat", "warm a", "heat a", "bring to a boil",
    "fill a", "fill the",
    "serve with", "toss to", "toss and serve", "combine then serve", "garnish with", "top and serve",
    "rinse ", "drain ", "clean and", "top with", "cover with", "line a", "spread the", "evenly spread",
    "put crab", "start by adding", "you can find", "if you", "grease baking", "stretch the", "cook ", "stir ",
    "for the ", "for filling", "for topping", "for garnish", "for sauce", "for dressing", "for marinade",
    "for glaze", "for frosting",
    "[video]", "**[", "recipe*", "&amp;x200b", "optional as topping", "check out my instagram",
    "support from", "if you make this", "if you like my recipes",
]
LOAD_NOTES = ["to taste", "optional", "as needed", "if desired", "for garnish"]
LOAD_SENTENCE_VERBS = [
    "fill", "toss", "serve", "mix", "stir", "cook", "bake", "heat", "add", "pour", "place", "combine",
    "whisk", "fold", "cut", "chop",
]
NO_AMOUNT_WORDS = ["to taste", "as needed", "taste", "needed"]
LEADING_QUANTITY_PATTERN = (
    r"(?i)^\d+(?:\.\d+)?(?:/\d+)?\s*(?:cups?|c\.|tbsp?|tsp?|tablespoons?|teaspoons?|oz|ounces?|lbs?|pounds?"
    r"|g|grams?|kg|ml|l|liters?|pieces?|pkg|packages?|cans?|jars?|bottles?)\s+"
)
# canonical name, abbreviation, type, spellings
UNITS = [
    ("cup", "c", "volume", ["cup", "cups", "c"]),
    ("tablespoon", "tbsp", "volume", ["tablespoon", "tablespoons", "tbsp", "tbs"]),
    ("teaspoon", "tsp", "volume", ["teaspoon", "teaspoons", "tsp"]),
    ("liter", "L", "volume", ["liter", "liters", "l"]),
    ("milliliter", "mL", "volume", ["milliliter", "milliliters", "ml"]),
    ("pint", "pt", "volume", ["pint", "pints"]),
    ("quart", "qt", "volume", ["quart", "quarts"]),
    ("gallon", "gal", "volume", ["gallon", "gallons"]),
    ("pound", "lb", "weight", ["pound", "pounds", "lb", "lbs"]),
    ("ounce", "oz", "weight", ["ounce", "ounces", "oz"]),
    ("gram", "g", "weight", ["gram", "grams", "g", "gr"]),
    ("kilogram", "kg", "weight", ["kilogram", "kilograms", "kg"]),
    ("piece", "pc", "count", ["piece", "pieces", "pc", "pcs"]),
    ("whole", "whole", "count", ["whole"]),
    ("item", "item", "count", ["item", "items"]),
    ("pinch", "pinch", "other", ["pinch", "pinches"]),
    ("dash", "dash", "other", ["dash", "dashes"]),
    ("to taste", "to taste", "other", ["to taste"]),
    ("as needed", "as needed", "other", ["as needed"]),
]
# name, abbreviation, type of the measurement rows every new table set starts with
SEED_MEASUREMENTS = [
    ("gram", "g", "weight"), ("kilogram", "kg", "weight"), ("milliliter", "ml", "volume"),
    ("liter", "l", "volume"), ("tablespoon", "tbsp", "volume"), ("teaspoon", "tsp", "volume"),
    ("cup", "cup", "volume"), ("piece", "pc", "count"), ("pinch", "pinch", "volume"),
    ("dash", "dash", "volume"),
]
RECIPE_NAMESPACE = "6ba7b8109dad11d180b400c04fd430c8"  # the DNS namespace of RFC 4122

# --- text analysis: the stop words of the standard English analyzer --------------------
STOP_WORDS = [
    "a", "an", "and", "are", "as", "at", "be", "but", "by", "for", "if", "in", "into", "is", "it", "no",
    "not", "of", "on", "or", "such", "that", "the", "their", "then", "there", "these", "they", "this", "to",
    "was", "will", "with",
]
