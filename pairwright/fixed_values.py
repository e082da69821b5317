"""Fixed values.

The patterns, mappings and thresholds below decide which records share a block
and which pairs count as matches, so they must have exactly these values for
results to agree. They are data, kept as plain text; all logic lives elsewhere.
Mappings are ordered: each entry is applied to the outcome of the one before.
"""

# --- Unstructured products (laptops) -------------------------------------------------

UNSTRUCTURED_SYMBOLS = r"[^\w\s\-,\.\*]"

LAPTOP_MAKERS = r"Lenovo|IBM|HP|Dell|Asus|Acer|MSI|Apple|Samsung|Toshiba|Sony|Panasonic|Fujitsu|LG|Microsoft|Gigabyte|Razer|Packard Bell|Schenker|Teclast|Nokia"
LAPTOP_SERIES = r"ThinkPad|IdeaPad|Yoga|EliteBook|ProBook|Spectre|Pavilion|Envy|Omen|ZBook|Latitude|Inspiron|XPS|Vostro|Alienware|Precision|G3|G7|ZenBook|VivoBook|ROG|Aspire|Predator|Nitro|TravelMate|Modern|Prestige|Stealth|Titan|MacBook|Galaxy Book|Tecra|Satellite|Qosmio|VAIO|Toughbook|Toughpad|Lifebook|Stylistic|Celsius|Surface Pro|Surface Laptop|AORUS|Blade|XMG|Netbook|kindle|Presario|Folio|Compaq"
CHIP_WORDS = r"Nvidia|Amd|Radeon|Athlon|Intel|Celeron|Atom|Pentium|Xeon"
CHIP_MAPPING = (
    (r"amd", "amd"),
    (r"intel", "intel"),
    (r"nvidia", "nvidia"),
    (r"radeon|athlon", "amd"),
    (r"celeron|atom|pentium|xeon", "intel"),
)
INTEL_CPU = r"(?<![a-zA-Z0-9])(?:intel\s+core\s+)?i[\s\-]*[3579](?:[\s\-]*\d{4,5}[A-Z]*)?(?![a-zA-Z0-9])"
NVIDIA_GPU = r"(?<![a-zA-Z0-9])(?:geforce\s+)?(?:gtx|gts|gt|gx|gs)?\s*(9[0-9]{2}|8[0-9]{2}|7[0-9]{2}|6[0-9]{2}|5[0-9]{2}|4[0-9]{2}|3[0-9]{2}|2[0-9]{2}|1[0-9]{2}|[1-9][0-9]?)(?:\s*ti)?(?![a-zA-Z0-9])"

UNSTRUCTURED_THRESHOLD = 0.925

# --- Structured products (storage devices) -------------------------------------------

SPEED_MAPPING = (
    (r"M(b(?!it)|B(?:yte)?)\s*(?:[\/\\]|per)?\s*(s|sec|second|sekunde|sek|sekunden|seconds)", "MB/s"),
)

CAPACITY = r"(?:1(?:\.0)?|2(?:\.0)?|4(?:\.0)?|8(?:\.0)?|16(?:\.0)?|32(?:\.0)?|64(?:\.0)?|128(?:\.0)?|256(?:\.0)?|512(?:\.0)?)\s*(?:GB|Gigabyte(?:s)?|TB|Terabyte(?:s)?)"
CAPACITY_MAPPING = (
    (r"(1(?:\.0)?)\s*(?:GB|Gigabyte(?:s)?)", "1 GB"),
    (r"(2(?:\.0)?)\s*(?:GB|Gigabyte(?:s)?)", "2 GB"),
    (r"(4(?:\.0)?)\s*(?:GB|Gigabyte(?:s)?)", "4 GB"),
    (r"(8(?:\.0)?)\s*(?:GB|Gigabyte(?:s)?)", "8 GB"),
    (r"(16(?:\.0)?)\s*(?:GB|Gigabyte(?:s)?)", "16 GB"),
    (r"(32(?:\.0)?)\s*(?:GB|Gigabyte(?:s)?)", "32 GB"),
    (r"(64(?:\.0)?)\s*(?:GB|Gigabyte(?:s)?)", "64 GB"),
    (r"(128(?:\.0)?)\s*(?:GB|Gigabyte(?:s)?)", "128 GB"),
    (r"(256(?:\.0)?)\s*(?:GB|Gigabyte(?:s)?)", "256 GB"),
    (r"(512(?:\.0)?)\s*(?:GB|Gigabyte(?:s)?)", "512 GB"),
    (r"(1(?:\.0)?)\s*(?:TB|Terabyte(?:s)?)", "1 TB"),
    (r"(2(?:\.0)?)\s*(?:TB|Terabyte(?:s)?)", "2 TB"),
    (r"(4(?:\.0)?)\s*(?:TB|Terabyte(?:s)?)", "4 TB"),
)

FORMAT_WORDS = r"(?:USB|Stick|Flash\sDriv|Thumb\sDrive|USB-Drive|jumpdrive|USB[123]|Type-A|Type-C|SD|Secure|Digital|SDHC|HC|SDXC|SDUC|UHS(?:-I|-II|-III)?|U3|U1|V\s*(?:6|10|30|60|90)|A1|A2|Class\s*[24610]|C\s*[24610]|ultimate|microSD(?:C|HC|XC)?|micro|CompactFlash|CF(?:-Karte)?|CFexpress|CF\sExpress|XQD)"
FORMAT_MAPPING = (
    (r"(?:USB|Stick|Flash\sDriv|Thumb\sDrive|USB-Drive|jumpdrive|USB[123]|Type-A|Type-C)", "USB"),
    (r"(?:microSD(?:C|HC|XC)?|micro)", "microSD"),
    (r"(?:SD|Secure|Digital|SDHC|HC|SDXC|SDUC|UHS(?:-I|-II|-III)?|U3|U1|V\s*(?:6|10|30|60|90)|A1|A2|Class\s*[24610]|C\s*[24610])", "SD"),
    (r"(?:CompactFlash|CF(?:-Karte)?|CFexpress|CF\sExpress)", "CF"),
    (r"(?:XQD)", "XQD"),
)

STORAGE_MAKER_WORDS = r"(?:Intenso|Kingston|Lexar|PNY|Samsung|SanDisk|Sony|Toshiba|Transcend|Verbatim|Western(?:\s)?Digital|Apacer|Corsair|pendrive|datatraveler|microvault|transmemory|cruzer|exceria|evo|extreme|ultra|edge|canvas|ultimate)"
STORAGE_MAKER_MAPPING = (
    (r"Intenso", "Intenso"),
    (r"Kingston|datatraveler", "Kingston"),
    (r"Lexar", "Lexar"),
    (r"PNY|pendrive", "PNY"),
    (r"Samsung|ultimate", "Samsung"),
    (r"SanDisk|cruzer|exceria|evo|extreme|ultra|edge|canvas", "SanDisk"),
    (r"Sony|microvault", "Sony"),
    (r"Toshiba|transmemory", "Toshiba"),
    (r"Transcend", "Transcend"),
    (r"Verbatim", "Verbatim"),
    (r"Western Digital", "Western Digital"),
    (r"WesternDigital", "Western Digital"),
    (r"Apacer", "Apacer"),
    (r"Corsair", "Corsair"),
)
STORAGE_SERIES = r"(?:pendrive|datatraveler|microvault|transmemory|cruzer|exceria|evo|extreme|ultra|edge|canvas|ultimate)"

STRUCTURED_THRESHOLD = 0.85
STRUCTURED_LARGE_BLOCK_THRESHOLD = 0.875
STRUCTURED_LARGE_BLOCK_ROWS = 7500
ADAPTIVE_BLOCK_ROWS = 2500

# --- Baseline ------------------------------------------------------------------------

BASELINE_KEY = r"\w+\s\w+\d+"
BASELINE_THRESHOLD = 0.5
BASELINE_KEY_ROWS = 100
