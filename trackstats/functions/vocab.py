"""Word lists, names and lookup tables that results depend on."""

# Lyric stop words.
LYRIC_STOPWORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him
his himself she her hers herself it its itself they them their theirs
themselves what which who whom this that these those am is are was were be been
being have has had having do does did doing a an the and but if or because as
until while of at by for with about against between into through during before
after above below to from up down in out on off over under again further then
once here there when where why how all any both each few more most other some
such no nor not only own same so than too very s t can will just don should now
im like oh yeah know got get cause let make see go right say one never come
time way want take love baby girl boy tell need feel aint wanna gonna gotta ooh
na la uh ya da ah hey chorus verse intro outro bridge pre post hook
""".split()

# Words of the public English stop-word list that are missing
# from the list above and can survive punctuation removal.
ENGLISH_EXTRA_STOPWORDS = """
d ll m o re ve y ain aren couldn didn doesn hadn hasn haven isn ma mightn mustn
needn shan shouldn wasn weren won wouldn
""".split()

# Topic vocabulary; the order decides which label wins.
TOPICS = [
    "Devoted Romantic Love", "Flirting and Early Dating", "Long Distance Love",
    "Destined Soulmate Love", "Unrequited Love", "Lust and Sexual Desire",
    "Heartbreak and Breakup Pain", "Toxic Relationship Drama",
    "Cheating and Jealousy", "Revenge on an Ex", "Moving On After Breakup",
    "Missing Someone", "Regret and Apology", "Party and Club Night",
    "Drinking and Getting Drunk", "Carefree Living in the Moment",
    "Dancing Anthem", "Flexing Wealth and Status", "Street Life and Violence",
    "Hustle and Success Story", "Fashion and Personal Style",
    "Drug and Substance Use", "Anxiety and Depression",
    "Escapism and Emotional Numbness", "Grief and Loss",
    "Healing and Resilience", "Female Empowerment",
    "Insecurity and Body Image", "Self Confidence and Affirmation",
    "Cultural Identity and Heritage", "Coming of Age",
    "Social and Political Commentary", "Resisting Societal Pressure",
    "Faith and Spirituality", "Existential Reflection",
    "Nostalgia and Childhood Memories", "Friendship and Loyalty",
    "Country and Rural Life", "Travel and Adventure",
    "Cute Couple Everyday Life", "Holiday and Christmas",
    "Kpop Idol Performance", "Electronic and Instrumental",
]

# Topics with their own band in the topic-share table.
SHARE_TOPICS = [
    "Flirting and Early Dating", "Unrequited Love", "Devoted Romantic Love",
    "Party and Club Night", "Lust and Sexual Desire",
    "Heartbreak and Breakup Pain", "Flexing Wealth and Status",
    "Destined Soulmate Love", "Toxic Relationship Drama",
    "Street Life and Violence", "Female Empowerment", "Dancing Anthem",
    "Escapism and Emotional Numbness", "Hustle and Success Story",
]

# Word categories, in display order.
CATEGORIES = [
    "Action", "Anatomy", "Brainrot", "Emotion", "Location", "Other", "Party",
    "Person", "Profanity", "Slang", "Time", "Vocalization", "Wealth",
]

# Note names by key number, and the circle of fifths.
KEY_NAMES = ["C", "C#/Db", "D", "D#/Eb", "E", "F", "F#/Gb", "G", "G#", "A", "A#/Bb", "B"]
CIRCLE_OF_FIFTHS = [0, 7, 2, 9, 4, 11, 6, 1, 8, 3, 10, 5]

# Industry events (year, label).
INDUSTRY_EVENTS = [
    (2013, "Vine Launches", "Birth of the 6-second loop. Forced music to rely on punchy, repetitive ad-libs for comedy sketches."),
    (2014, "Musical.ly Launches", "The Lip-Sync Era. 15-second audio snippets become more important than full tracks."),
    (2018, "TikTok Global Merger", "The Algorithm Takeover. Record labels begin forcing 'TikTok-friendly' hooks in the first 15 seconds."),
    (2020, "Pandemic Lockdowns", "Screen time peaks. Massive rise in user-generated dance trends and 'Sped-Up' remixes."),
    (2023, "Peak 'Brainrot'", "Hyper-fragmented, high-stimulation content dominates. Songs become significantly shorter with meme-focused lyrics."),
]

# Columns a clean row must have, and columns dropped on cleaning.
REQUIRED_COLUMNS = [
    "Lyrics", "acousticness", "danceability", "energy", "instrumentalness",
    "key", "liveness", "loudness", "mode", "speechiness", "tempo", "valence",
]
DROPPED_COLUMNS = [
    "genres", "main_genre", "first_genre", "second_genre", "third_genre",
    "reccobeats_processed",
]

# Measured features, and the twelve that get correlated.
AUDIO_FEATURES = [
    "acousticness", "danceability", "energy", "instrumentalness", "liveness",
    "loudness", "speechiness", "tempo", "valence", "duration_min",
]
TEXT_FEATURES = [
    "Flesch_Kincaid_Grade", "Lexical_Diversity", "Avg_Word_Length",
    "Sentiment_Score",
]
CORRELATED_FEATURES = [
    "acousticness", "danceability", "energy", "instrumentalness", "key",
    "liveness", "loudness", "mode", "speechiness", "tempo", "valence",
    "duration_ms",
]

# Features measured on the unit interval.
UNIT_FEATURES = [
    "acousticness", "danceability", "energy", "instrumentalness", "liveness",
    "speechiness", "valence",
]

# Fixed values: (lower, upper, value used when the upper bound is missing or 0);
# None takes the data's own minimum or maximum.
FEATURE_BOUNDS = {
    **{f: (0.0, 1.0, 1.0) for f in UNIT_FEATURES},
    "loudness": (-60.0, None, 0.0),
    "tempo": (0.0, None, 1.0),
    "duration_min": (0.0, None, 10.0),
    "Sentiment_Score": (-1.0, 1.0, 1.0),
}
OPEN_BOUNDS = (None, None, 1.0)

# Quadrant names as (top right, top left, bottom left, bottom right).
QUADRANTS = {
    ("valence", "energy"): (
        "Euphoric Anthems", "Dark & Aggressive", "Melancholy Heartbreak", "Chill & Breezy"),
    ("danceability", "acousticness"): (
        "Organic Groove", "Intimate Showcase", "Electronic Atmosphere", "Synthetic Bangers"),
}

# Label overrides and short labels.
LABEL_OVERRIDES = {"duration_min": "Duration (min)", "Sentiment_Score": "Sentiment Score"}
SHORT_LABELS = {
    "Instrumentalness": "Instr.", "Danceability": "Dance.",
    "Acousticness": "Acoustic.", "Speechiness": "Speech.",
}

# Text that means "no value" in a loaded CSV.
MISSING_TEXT = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

DEFAULT_YEAR = 2024
