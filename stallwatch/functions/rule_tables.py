"""Rule tables of the taxonomy. First match wins, in the order given."""

# Categories and the words that mean them.
CATEGORIES = {
    "t-shirts": ["t-shirt", " tee ", " tee,", "تيشيرت", "jersey tee", "jersey t"],
    "sweatshirts": ["sweatshirt", "سويت شيرت"],
    "hoodies": ["hoodie", "hoody", "هودي"],
    "shirts": ["shirt", "blouse", "tunic", "تونيك", "قميص", "بلوزة"],
    "polos": ["polo"],
    "cardigans": ["cardigan", "كارديجان"],
    "sweaters": ["sweater", "pullover", "knitwear", "knit", "بلوفر"],
    "bodysuits": ["bodysuit", "body suit", "بودي"],
    "tank-tops": ["tank", "sleeveless top", "cami", "spaghetti"],
    "jeans": ["jean", "denim trouser", "دينيم", "جينز"],
    "trousers": ["trouser", "pant", "chino", "بنطلون", "slacks"],
    "shorts": ["short", "شورت"],
    "skirts": ["skirt", "تنورة", "jupe"],
    "leggings": ["legging", "تايتس", "tight"],
    "joggers": ["jogger", "sweatpant", "tracksuit bottom", "jogging"],
    "sweatpants": ["sweat pant"],
    "jackets": ["jacket", "puffer", "parka", "windbreaker", "جاكيت"],
    "coats": ["coat", "overcoat", "معطف"],
    "blazers": ["blazer", "بليزر"],
    "vests": ["vest", "gilet", "صدرية"],
    "dresses": ["dress", "فستان", "maxi dress", "midi dress", "mini dress"],
    "jumpsuits": ["jumpsuit", "playsuit", "overall", "romper", "جمبسوت"],
    "kaftans": ["kaftan", "قفطان", "abaya", "عباية", "jalabiya", "جلابية"],
    "sneakers": ["sneaker", "trainer", "athletic shoe", "سنيكر", "كوتشي"],
    "sandals": ["sandal", "flip flop", "flip-flop", "صندل"],
    "boots": ["boot", "بوت"],
    "loafers": ["loafer", "moccasin", "slip-on", "flat shoe"],
    "heels": ["heel", "pump", "wedge", "stiletto"],
    "slippers": ["slipper", "house shoe", "شبشب"],
    "bags": ["bag", "handbag", "backpack", "tote", "clutch", "شنطة", "حقيبة"],
    "belts": ["belt", "حزام"],
    "scarves": ["scarf", "شال", "stole"],
    "hats": ["hat", "cap", "beanie", "قبعة", "طاقية"],
    "jewelry": ["jewelry", "jewellery", "necklace", "bracelet", "ring", "earring", "مجوهرات"],
    "watches": ["watch", "ساعة"],
    "sunglasses": ["sunglass", "eyewear", "نظارة"],
    "socks": ["sock", "جوارب", "stocking"],
    "underwear": ["underwear", "bra", "brief", "boxer", "lingerie", "ملابس داخلية"],
    "swimwear": ["swimwear", "swimsuit", "bikini", "swim trunk", "مايوه"],
    "loungewear": ["pyjama", "pajama", "nightwear", "sleepwear", "homewear", "بيجامة"],
    "sportswear": ["sport", "gym", "athletic", "workout", "training", "active"],
}
# Genders.
GENDERS = {"women": ["women", "woman", "female", "ladies", "girl", "نسائي"], "men": ["men", "man", "male", "gents", "رجالي"], "kids": ["kid", "child", "baby", "infant", "أطفال"]}
# Genders of the first level of a breadcrumb.
BREADCRUMB_GENDERS = {"men": "men", "man": "men", "رجال": "men", "رجالي": "men", "women": "women", "woman": "women", "نساء": "women", "نسائي": "women", "kids": "kids", "children": "kids", "أطفال": "kids"}
# Words that rescue products without a category.
RESCUES = {"cardigan": "cardigans", "pullover": "sweaters", "sweatshirt": "shirts", "blouse": "shirts", "tunic": "shirts", "henley": "t-shirts", "tank": "tank-tops", "vest": "vests", "long-sleeve": "shirts", "long sleeve": "shirts"}
# Subcategories by category, pattern, label and priority (lower first).
SUBCATEGORIES = [
    ("t-shirts", r"long[\s\-]?sleeve", "long-sleeve", 10), ("t-shirts", r"short[\s\-]?sleeve|half[\s\-]?sleeve", "short-sleeve", 10), ("t-shirts", r"sleeve\s?less|no[\s\-]?sleeve", "sleeveless", 10), ("t-shirts", r"over[\s\-]?size", "oversized", 20), ("t-shirts", r"graphic|printed|print\b", "graphic-printed", 30), ("t-shirts", r"basic|plain|solid", "basic", 40),
    ("shirts", r"long[\s\-]?sleeve", "long-sleeve", 10), ("shirts", r"short[\s\-]?sleeve|half[\s\-]?sleeve", "short-sleeve", 10), ("shirts", r"over[\s\-]?shirt", "overshirt", 15), ("shirts", r"flannel", "flannel", 20), ("shirts", r"linen", "linen", 20), ("shirts", r"formal|classic|dress shirt", "formal", 30),
    ("trousers", r"chino", "chino", 10), ("trousers", r"cargo", "cargo", 10), ("trousers", r"formal|suit|classic", "formal", 20), ("trousers", r"wide[\s\-]?leg", "wide-leg", 20), ("trousers", r"jogger", "jogger-style", 20),
    ("jeans", r"slim|skinny", "slim", 10), ("jeans", r"straight|regular", "straight", 10), ("jeans", r"wide|baggy|loose|relaxed", "wide-baggy", 10), ("jeans", r"\bmom\b", "mom-fit", 10), ("jeans", r"flare|boot[\s\-]?cut", "flare", 10),
    ("shorts", r"denim|jeans", "denim", 10), ("shorts", r"chino", "chino", 10), ("shorts", r"sport|swim|training|running", "sport", 10),
    ("dresses", r"\bmaxi\b", "maxi", 10), ("dresses", r"\bmidi\b", "midi", 10), ("dresses", r"\bmini\b", "mini", 10), ("skirts", r"\bmaxi\b", "maxi", 10), ("skirts", r"\bmidi\b", "midi", 10), ("skirts", r"\bmini\b", "mini", 10),
    ("sweaters", r"crew[\s\-]?neck|round[\s\-]?neck", "crewneck", 10), ("sweaters", r"turtle[\s\-]?neck|high[\s\-]?neck|mock[\s\-]?neck", "turtleneck", 10), ("sweaters", r"v[\s\-]?neck", "v-neck", 10), ("sweaters", r"\bzip", "zip", 10),
    ("hoodies", r"zip", "zip-up", 10), ("hoodies", r"pullover|over[\s\-]?head", "pullover", 20),
    ("jackets", r"denim|jeans", "denim", 10), ("jackets", r"bomber", "bomber", 10), ("jackets", r"puffer|padded|quilted", "puffer", 10), ("jackets", r"leather", "leather", 10), ("jackets", r"wind[\s\-]?breaker", "windbreaker", 10),
]
# Colours.
COLORS = [
    ("اسود", "black"), ("black", "black"), ("off white", "white"), ("offwhite", "white"), ("ecru", "white"), ("cream", "white"), ("ivory", "white"), ("white", "white"), ("navy", "navy"),
    ("denim", "blue"), ("indigo", "blue"), ("turquoise", "blue"), ("petrol", "blue"), ("blue", "blue"), ("vison", "beige"), ("nude", "beige"), ("sand", "beige"), ("tan", "beige"), ("stone", "beige"), ("biscuit", "beige"), ("beige", "beige"),
    ("anthracite", "grey"), ("charcoal", "grey"), ("grey", "grey"), ("gray", "grey"), ("silver", "grey"), ("coffee", "brown"), ("camel", "brown"), ("chocolate", "brown"), ("mink", "brown"), ("taupe", "brown"), ("brown", "brown"),
    ("khaki", "olive"), ("olive", "olive"), ("mint", "green"), ("teal", "green"), ("emerald", "green"), ("green", "green"), ("rose", "pink"), ("fuchsia", "pink"), ("fuschia", "pink"), ("magenta", "pink"), ("salmon", "pink"), ("pink", "pink"),
    ("burgundy", "red"), ("maroon", "red"), ("wine", "red"), ("crimson", "red"), ("bordeaux", "red"), ("red", "red"), ("mustard", "yellow"), ("gold", "yellow"), ("yellow", "yellow"), ("peach", "orange"), ("coral", "orange"), ("apricot", "orange"), ("orange", "orange"),
    ("lilac", "purple"), ("lavender", "purple"), ("mauve", "purple"), ("violet", "purple"), ("plum", "purple"), ("purple", "purple"), ("multi", "multi"), ("colored", "multi"), ("colour", "multi"), ("print", "multi"), ("floral", "multi"), ("striped", "multi"),
]
# Colour families of the colour map, the special words before the general ones.
COLOR_FAMILIES = [
    ("اسود", "black"), ("ابيض", "white"), ("black", "black"), ("off white", "white"), ("offwhite", "white"), ("ecru", "white"), ("cream", "white"), ("ivory", "white"), ("white", "white"),
    ("anthracite", "grey"), ("charcoal", "grey"), ("silver", "grey"), ("grey", "grey"), ("gray", "grey"),
    ("vison", "beige"), ("nude", "beige"), ("sand", "beige"), ("tan", "beige"), ("stone", "beige"), ("biscuit", "beige"), ("caramel", "beige"), ("beige", "beige"),
    ("coffee", "brown"), ("camel", "brown"), ("chocolate", "brown"), ("mink", "brown"), ("taupe", "brown"), ("mocha", "brown"), ("brown", "brown"),
    ("teal", "teal"), ("turquoise", "teal"), ("navy", "blue"), ("denim", "blue"), ("indigo", "blue"), ("cobalt", "blue"), ("petrol", "blue"), ("sky", "blue"), ("blue", "blue"),
    ("khaki", "green"), ("olive", "green"), ("mint", "green"), ("emerald", "green"), ("sage", "green"), ("green", "green"), ("mustard", "yellow"), ("gold", "yellow"), ("lemon", "yellow"), ("yellow", "yellow"),
    ("peach", "orange"), ("coral", "orange"), ("apricot", "orange"), ("rust", "orange"), ("terracotta", "orange"), ("orange", "orange"),
    ("burgundy", "burgundy"), ("maroon", "burgundy"), ("wine", "burgundy"), ("bordeaux", "burgundy"), ("crimson", "red"), ("red", "red"),
    ("rose", "pink"), ("fuchsia", "pink"), ("fuschia", "pink"), ("magenta", "pink"), ("salmon", "pink"), ("blush", "pink"), ("pink", "pink"),
    ("lilac", "purple"), ("lavender", "purple"), ("mauve", "purple"), ("violet", "purple"), ("plum", "purple"), ("purple", "purple"),
    ("metallic", "metallic"), ("chrome", "metallic"), ("copper", "metallic"), ("bronze", "metallic"),
    ("multi", "multi"), ("colored", "multi"), ("colour", "multi"), ("print", "multi"), ("floral", "multi"), ("striped", "multi"), ("pattern", "multi"), ("tie dye", "multi"), ("camo", "multi"),
]
# Arabic colours, in the spellings that shops use, and their English names.
ARABIC_COLORS = {
    "أسود": "black", "اسود": "black", "أبيض": "white", "ابيض": "white", "اوف وايت": "off-white", "أوف وايت": "off-white", "رمادي": "grey", "رصاصي": "grey", "جراي": "grey", "أحمر": "red", "احمر": "red",
    "أزرق": "blue", "ازرق": "blue", "لبني": "light blue", "سماوي": "sky blue", "بترولي": "petrol", "كحلي": "navy", "نيفي": "navy", "أخضر": "green", "اخضر": "green", "زيتي": "olive", "زيتوني": "olive",
    "أصفر": "yellow", "اصفر": "yellow", "وردي": "pink", "زهري": "pink", "روز": "rose", "بمبي": "pink", "بنفسجي": "purple", "موف": "mauve", "موفي": "mauve", "ليلكي": "lilac", "لافندر": "lavender",
    "برتقالي": "orange", "مشمشي": "apricot", "بني": "brown", "جملي": "camel", "كاميل": "camel", "عسلي": "tan", "ترابي": "taupe", "بيج": "beige", "كريمي": "cream", "كريم": "cream",
    "ذهبي": "gold", "جولد": "gold", "فضي": "silver", "سيلفر": "silver", "نحاسي": "copper", "تركواز": "turquoise", "تيفاني": "teal",
    "خمري": "burgundy", "نبيتي": "burgundy", "عنابي": "burgundy", "بوردو": "burgundy", "ماروني": "maroon", "كاكي": "khaki", "خاكي": "khaki", "فوشيا": "fuchsia", "مرجاني": "coral", "كورال": "coral",
    "نعناعي": "mint", "منت": "mint", "ملون": "multicolor", "متعدد الألوان": "multicolor", "مطبوع": "printed", "مشجر": "floral",
}
# Turkish colours and their English names.
TURKISH_COLORS = {
    "siyah": "black", "beyaz": "white", "gri": "grey", "antrasit": "anthracite", "kirmizi": "red", "bordo": "burgundy", "pembe": "pink", "fusya": "fuchsia", "mercan": "coral", "turuncu": "orange", "sari": "yellow", "ekru": "ecru",
    "bej": "beige", "kahve": "brown", "haki": "khaki", "yesil": "green", "petrol": "petrol", "turkuaz": "turquoise", "mavi": "blue", "lacivert": "navy", "indigo": "indigo", "mor": "purple", "murdum": "plum", "lila": "lilac", "cokrenkli": "multicolor",
}
# Sizes.
LETTERS = {"xxs": "XXS", "xs": "XS", "s": "S", "m": "M", "l": "L", "xl": "XL", "xxl": "2XL", "2xl": "2XL", "xxxl": "3XL", "3xl": "3XL", "4xl": "4XL", "5xl": "5XL", "6xl": "6XL", "7xl": "7XL", "small": "S", "medium": "M", "large": "L"}
EU_LETTERS = {"34": "XXS", "36": "XS", "38": "S", "40": "M", "42": "L", "44": "L", "46": "XL", "48": "2XL", "50": "3XL", "52": "3XL", "54": "4XL", "56": "4XL", "58": "5XL", "60": "5XL"}
ONE_SIZE = ["one size", "onesize", "os", "free", "free size", "freesize"]
# Categories whose numbers are waists.
BOTTOMS = ["trousers", "jeans", "shorts", "joggers", "sweatpants", "leggings"]
# Categories whose numbers are European sizes.
TOPS_EU = ["t-shirts", "shirts", "dresses", "skirts", "sweaters", "cardigans", "jackets", "coats", "blazers", "vests", "hoodies", "sweatshirts", "polos", "tank-tops", "jumpsuits", "kaftans", "bodysuits", "pajamas"]
# Categories that have sleeves.
TOPS = ["t-shirts", "shirts", "polos", "sweatshirts", "hoodies", "cardigans", "sweaters", "bodysuits", "tank-tops", "blazers"]
# Colours that stand where sizes should, and patterns of sizes to be reviewed.
SIZE_COLORS = "black|white|off[ _-]?white|grey|gray|beige|brown|blue|navy|nave[_ ]?blue|teal|petrol|petrol[_ ]?blue|green|olive|khaki|yellow|orange|red|burgundy|maroon|pink|rose|purple|lilac|lavender|mauve|gold|silver|copper|turquoise|fuchsia|coral|mint|cream|camel|tan|taupe|multi|stone|vison|ecru|russet|anthrcite|anthracite|d[_ ]?blue|light[_ ]?blue|dark[_ ]?grey|dark[_ ]?blue|sky[_ ]?blue|royal[_ ]?blue|bottel[_ ]?green|olive[_ ]?green"
SIZE_REVIEWS = [
    ("^beden *[0-9]+ *- *boy *[0-9]+$", "turkish_dual_size_height"), ("^[0-9]{2,3}[ _-][0-9]{2,3}$", "possible_waist_inseam_combo"), ("^(xs|s|m|l|xl|2xl|3xl)[ /-](xs|s|m|l|xl|2xl|3xl)$", "dual_letter_range"),
    ("^(xs|s|m|l|xl)[ /-][0-9]{2,3}$", "letter_plus_eu_combo"), ("^[0-9]{2,3} */ *[ab]$", "possible_bra_band_size"), ("^x/xx$", "ambiguous_dual_notation"), ("^[0-9]{1,2}[ _-][0-9]{1,2}$", "bare_numeric_range_unclear_domain"),
]
# Sleeve lengths; of phrases of one length the first stands.
SLEEVES = [
    ("short sleeve", "short sleeve"), ("short-sleeve", "short sleeve"), ("short sleeves", "short sleeve"), ("short-sleeves", "short sleeve"), ("long sleeve", "long sleeve"), ("long-sleeve", "long sleeve"), ("long sleeves", "long sleeve"), ("long-sleeves", "long sleeve"),
    ("half sleeve", "half sleeve"), ("half-sleeve", "half sleeve"), ("half sleeves", "half sleeve"), ("full sleeve", "long sleeve"), ("full-sleeve", "long sleeve"), ("full sleeves", "long sleeve"),
    ("sleeveless", "sleeveless"), ("elbow sleeve", "elbow sleeve"), ("elbow-sleeve", "elbow sleeve"), ("3/4 sleeve", "three-quarter sleeve"), ("three-quarter sleeve", "three-quarter sleeve"),
]
# Colours that titles name, longest first when several fit.
TITLE_COLORS = [
    "off-white", "off white", "light blue", "sky blue", "baby blue", "navy blue", "mid blue", "dark blue", "ocean blue", "marine blue", "acid blue", "bright mid blue", "powder blue", "midnight navy",
    "light grey", "dark grey", "washed black", "washed grey", "vintage blue", "deep vintage blue", "oat beige", "rose gold", "mint green", "dark olive", "dark mint", "steel blue", "army green",
    "black", "white", "grey", "gray", "anthracite", "red", "burgundy", "pink", "fuchsia", "coral", "orange", "yellow", "ecru", "beige", "brown", "khaki", "green", "olive", "petrol", "turquoise", "blue", "navy", "indigo", "purple", "plum", "lilac",
    "multicolor", "cream", "gold", "silver", "copper", "camel", "tan", "taupe", "mauve", "lavender", "apricot", "maroon", "mint", "chocolate", "honey", "lemon", "rose",
]
# Names of materials that read like colours.
MATERIALS = [r"\b(raw\s+)?denim\b", r"\bice\b"]
# Marks of colour names that are none.
COLOR_JUNK, COLOR_NUMBERS = "size|cm|ml|kg|pcs|/|x |0x", "^[.-]*[0-9][0-9.-]*$"
# Metals.
METALS = ["gold", "silver", "copper"]
# Cuts of trousers by phrase; of phrases of one length the first stands.
CUTS = [
    ("extreme wide leg", "wide leg"), ("super baggy", "baggy"), ("loose baggy", "baggy"), ("wide leg", "wide leg"), ("wide-leg", "wide leg"), ("wideleg", "wide leg"), ("wide tailored", "wide leg"), ("skinny fit", "skinny"), ("slim fit", "slim"), ("slim-fit", "slim"),
    ("regular fit", "regular"), ("relaxed fit", "relaxed"), ("straight fit", "straight"), ("tapered fit", "tapered"), ("high waist", "high waist"), ("high-waist", "high waist"), ("boyfriend", "boyfriend"), ("mom fit", "mom fit"), ("mom-fit", "mom fit"), ("momfit", "mom fit"),
    ("mom jeans", "mom fit"), ("bootcut", "bootcut"), ("boot cut", "bootcut"), ("flare", "flare"), ("flared", "flare"), ("baggy", "baggy"), ("skinny", "skinny"), ("slim", "slim"), ("straight", "straight"), ("tapered", "tapered"), ("relaxed", "relaxed"), ("loose", "baggy"),
    ("jogger", "jogger"), ("joggers", "jogger"), ("cargo", "cargo"), ("chino", "chino"), ("chinos", "chino"), ("sweatpants", "sweatpants"), ("sweatpant", "sweatpants"), ("curvy fit", "curvy fit"), ("skater", "skater"),
]
# Dresses, jackets, underwear, swimwear and bags.
DRESS_LENGTHS = {"mini": ["mini dress", "mini"], "midi": ["midi dress", "midi"], "maxi": ["maxi dress", "maxi"], "knee-length": ["knee length", "knee-length"], "ankle-length": ["ankle length", "ankle-length"]}
DRESS_SHAPES = {"fit and flare": ["fit and flare", "fit-and-flare", "fit & flare"], "a-line": ["a-line", "a line"], "bodycon": ["bodycon"], "shirt dress": ["shirt dress"], "wrap": ["wrap dress"], "shift": ["shift dress"], "slip": ["slip dress"], "bandage": ["bandage"]}
JACKETS = [
    ("denim jacket", "denim"), ("leather jacket", "leather"), ("bomber jacket", "bomber"), ("puffer jacket", "puffer"), ("biker jacket", "biker"), ("puffer", "puffer"), ("bomber", "bomber"), ("blazer", "blazer"), ("parka", "parka"), ("trench", "trench"),
    ("quilted", "quilted"), ("windbreaker", "windbreaker"), ("biker", "biker"), ("varsity", "varsity"),
]
TOP_HINTS = ["bra", "bralette", "lingerie top", "corset", "bustier"]
BOTTOM_HINTS = ["panty", "panties", "brief", "knicker", "boxer", "thong"]
TOP_STYLES = {"push-up": ["push-up", "push up"], "padded": ["padded"], "unpadded": ["unpadded"], "wireless": ["wireless", "wire-free", "non-wired"], "wired": ["wired"], "strapless": ["strapless"], "seamless": ["seamless"], "bralette": ["bralette"]}
BOTTOM_STYLES = {"bikini": ["bikini brief"], "boyshort": ["boy short", "boyshort"], "brazilian": ["brazilian"], "hipster": ["hipster"], "thong": ["thong"], "full brief": ["full coverage", "full brief"]}
SWIMWEAR = {"board short": ["board short"], "one-piece": ["one-piece", "one piece"], "bikini": ["bikini"], "swimsuit": ["swimsuit"], "tankini": ["tankini"], "burkini": ["burkini"]}
BAGS = {
    "shoulder bag": ["shoulder bag"], "crossbody": ["crossbody bag", "crossbody"], "tote": ["tote bag", "tote"], "backpack": ["backpack"], "clutch": ["clutch"], "duffel": ["duffel"], "wallet": ["wallet"], "satchel": ["satchel"], "handbag": ["handbag"], "sling": ["sling bag", "sling"], "messenger": ["messenger bag", "messenger"],
}
