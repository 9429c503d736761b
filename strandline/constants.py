"""Fixed values that results depend on: word lists, lookup tables, rates."""

# Month spellings of a title -> month number.
MONTHS = {
    "jan": 1, "january": 1, "feb": 2, "february": 2, "mar": 3, "march": 3,
    "apr": 4, "april": 4, "may": 5, "jun": 6, "june": 6, "jul": 7, "july": 7,
    "aug": 8, "august": 8, "sep": 9, "sept": 9, "september": 9,
    "oct": 10, "october": 10, "nov": 11, "november": 11, "dec": 12, "december": 12,
}

# Venue spellings (folded tokens) -> venue code.
VENUES = {
    "makkah": "makkah", "mecca": "makkah", "makka": "makkah", "makkha": "makkah",
    "haram": "makkah", "masjidalharam": "makkah",
    "madeenah": "madeenah", "madinah": "madeenah", "madina": "madeenah",
    "medina": "madeenah", "medinah": "madeenah", "madeena": "madeenah",
    "nabawi": "madeenah", "masjidannabawi": "madeenah",
}

# Session spellings (folded tokens) -> session code.
SESSIONS = {
    "fajr": "fajr", "fajir": "fajr", "subh": "fajr",
    "dhuhr": "dhuhr", "duhr": "dhuhr", "zuhr": "dhuhr", "zuhur": "dhuhr", "dhuhur": "dhuhr",
    "asr": "asr", "assr": "asr",
    "maghrib": "maghrib", "magrib": "maghrib", "maghreb": "maghrib",
    "isha": "isha", "ishaa": "isha", "esha": "isha",
    "jumuah": "jumuah", "jumah": "jumuah", "jumma": "jumuah", "juma": "jumuah",
    "friday": "jumuah", "khutbah": "jumuah", "khutba": "jumuah",
    "taraweeh": "taraweeh", "tarawih": "taraweeh", "taraweh": "taraweeh", "taraaweeh": "taraweeh",
    "tahajjud": "tahajjud", "tahajud": "tahajjud", "qiyam": "tahajjud", "qiyaam": "tahajjud",
    "witr": "witr",
    "eid": "eid", "eidul": "eid",
    "janazah": "janazah", "janaza": "janazah", "funeral": "janazah",
    "istisqa": "istisqa", "istasqa": "istisqa", "istisqaa": "istisqa",
    "kusuf": "kusuf", "khusuf": "kusuf", "eclipse": "kusuf",
}

# Tokens that mark a call, an honorific, an 'Eid qualifier, or nothing.
CALLS = ["adhaan", "adhan", "athan", "azan", "adzan"]
HONORIFICS = ["sheikh", "shaykh", "shaikh", "sh", "shk", "imam", "imaam"]
EID_QUALIFIERS = ["ul", "al", "fitr", "adha"]
NOISE = ["led", "by", "the", "at", "from", "with", "and", "of", "in", "prayer", "salah", "salaah", "salat", "salaat"]

# Which sessions are recited aloud, which silently; all others are unknown.
AUDIBLE = ["fajr", "maghrib", "isha", "jumuah", "taraweeh", "tahajjud", "witr", "eid", "istisqa"]
SILENT = ["dhuhr", "asr"]

# Reason codes and their labels.
REASON_LABELS = {
    "ok": "Analysed",
    "adhaan": "Call to prayer — no Qur'an recited",
    "silent-recitation": "Silent recitation — nothing audible to transcribe",
    "unparsed-title": "Title not understood",
}

# Order of the sessions on a day's page.
DAY_ORDER = ["fajr", "dhuhr", "jumuah", "asr", "maghrib", "isha", "taraweeh", "tahajjud"]

# Confidence below which a parsed title needs a look; slack of a title's date in days.
CONFIDENCE_LIMIT = 0.6
UPLOAD_SLACK_DAYS = 1

# Seconds assumed where none are reported, by session.
ASSUMED_SECONDS = {"fajr": 1200, "maghrib": 600, "isha": 900, "jumuah": 1500, "taraweeh": 5400, "tahajjud": 5400}
ASSUMED_SECONDS_DEFAULT = 900

# Tokens per second of input (video, audio), output tokens per minute, share paid in a batch.
VIDEO_TOKENS_PER_SECOND = 60
AUDIO_TOKENS_PER_SECOND = 32
OUTPUT_TOKENS_PER_MINUTE = 350
BATCH_FACTOR = 0.5

# Letters of the comparison skeleton, all others of the block stay.
SKELETON_MARKS = "\\u0610-\\u061A\\u064B-\\u065F\\u0670\\u06D6-\\u06ED\\u08D3-\\u08FF\\u0640"
SKELETON_TO = {"ى": "ي", "ئ": "ي", "ی": "ي", "ے": "ي", "ؤ": "و", "ة": "ه", "ٮ": "ب", "ٯ": "ق"}
SKELETON_DROP = "اأإآٱٲٳٵء"

# Fixed value: the opening formula, which is no evidence for any verse.
BOILERPLATE = "بِسْمِ ٱللَّهِ ٱلرَّحْمَٰنِ ٱلرَّحِيمِ"
