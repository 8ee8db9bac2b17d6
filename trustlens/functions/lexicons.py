"""Fixed values that must equal the reference's for equal results.

Everything in this module is data, written out plainly and in the order the
reference lists it. Functions elsewhere take these as default arguments, so a
caller can pass other tables.
"""

# --- fixed values: slang normalisation table (77 distinct keys) -------------
# Later duplicates of a key in the reference's literal are dropped; the value
# is the same for every duplicate.
SLANG = {
    "gak": "tidak",
    "ga": "tidak",
    "ngga": "tidak",
    "nggak": "tidak",
    "gk": "tidak",
    "tdk": "tidak",
    "gpp": "tidak apa apa",
    "bgt": "banget",
    "bgd": "banget",
    "bngd": "banget",
    "bngt": "banget",
    "bener": "benar",
    "emg": "memang",
    "emng": "memang",
    "udh": "sudah",
    "udah": "sudah",
    "dah": "sudah",
    "blm": "belum",
    "blom": "belum",
    "jg": "juga",
    "jgn": "jangan",
    "dgn": "dengan",
    "sm": "sama",
    "gmn": "bagaimana",
    "gmana": "bagaimana",
    "knp": "kenapa",
    "knapa": "kenapa",
    "krn": "karena",
    "krna": "karena",
    "karna": "karena",
    "tp": "tetapi",
    "tapi": "tetapi",
    "yg": "yang",
    "utk": "untuk",
    "org": "orang",
    "sdh": "sudah",
    "trs": "terus",
    "bs": "bisa",
    "bsa": "bisa",
    "sy": "saya",
    "kl": "kalau",
    "klo": "kalau",
    "kalo": "kalau",
    "byk": "banyak",
    "banyak": "banyak",
    "skrg": "sekarang",
    "skr": "sekarang",
    "skg": "sekarang",
    "hrs": "harus",
    "trmksh": "terima kasih",
    "mksh": "terima kasih",
    "thx": "terima kasih",
    "thanks": "terima kasih",
    "thks": "terima kasih",
    "mantap": "mantap",
    "mantul": "mantap",
    "mantep": "mantap",
    "keren": "keren",
    "bagus": "bagus",
    "jelek": "jelek",
    "buruk": "buruk",
    "enak": "enak",
    "mantab": "mantap",
    "rekomend": "rekomendasi",
    "rekomen": "rekomendasi",
    "recommended": "rekomendasi",
    "poll": "banget",
    "poolll": "banget",
    "pol": "banget",
    "sih": "",
    "si": "",
    "nih": "",
    "nii": "",
    "ya": "",
    "yaa": "",
    "iya": "ya",
    "yoi": "ya",
}

# --- fixed values: the trainers' shorter slang table (26 keys) --------------
SLANG_TRAINER = {
    "gak": "tidak", "ga": "tidak", "ngga": "tidak", "nggak": "tidak", "gk": "tidak",
    "tdk": "tidak", "bgt": "banget", "bngt": "banget", "emg": "memang",
    "udh": "sudah", "udah": "sudah", "blm": "belum", "jg": "juga", "dgn": "dengan",
    "yg": "yang", "utk": "untuk", "sy": "saya", "kl": "kalau", "klo": "kalau",
    "thx": "terima kasih", "thanks": "terima kasih", "mantul": "mantap", "mantep": "mantap",
    "rekomend": "rekomendasi", "rekomen": "rekomendasi", "recommended": "rekomendasi",
}

# The predictors' table has one key more.
SLANG_PREDICTOR = {**SLANG_TRAINER, "bgd": "banget"}

# --- fixed values: common-word lexicon for the valid-word ratio (105 words) --
LEXICON = (
    "ini", "itu", "yang", "untuk", "dari", "dengan", "tidak", "ada", "adalah", "dan",
    "atau", "jika", "maka", "karena", "tetapi", "tapi", "sudah", "belum", "akan",
    "sangat", "kurang", "lebih", "baik", "buruk", "bagus", "jelek", "enak", "lezat",
    "makanan", "minuman", "tempat", "lokasi", "pelayanan", "layanan", "harga", "murah",
    "mahal", "recommended", "rekomendasi", "mantap", "keren", "oke", "suka", "senang",
    "puas", "kecewa", "bersih", "kotor", "nyaman", "ramai", "sepi", "cepat", "lambat",
    "ramah", "sopan", "kasar", "menu", "porsi", "rasa", "besar", "kecil", "banyak",
    "sedikit", "panas", "dingin", "hangat", "segar", "basi", "asin", "manis", "pahit",
    "pedas", "gurih", "hambar", "saya", "kamu", "kami", "mereka", "dia", "anda",
    "disini", "disana", "kemari", "kesana", "datang", "pergi", "tiba", "sampai",
    "masuk", "keluar", "buka", "tutup", "beli", "bayar", "order", "pesan", "makan",
    "minum", "coba", "cari", "lihat", "tunggu", "antri", "duduk", "berdiri",
)

# --- fixed values: letters counted as vowels and consonants -----------------
VOWELS = "aeiouAEIOU"
CONSONANTS = "bcdfghjklmnpqrstvwxyzBCDFGHJKLMNPQRSTVWXYZ"

# --- fixed values: labelling reasons, in rule order --------------------------
REASON_FIVE_NO_TEXT = "Bintang 5 tanpa teks"
REASON_FIVE_SHORT = "Bintang 5 & teks sangat pendek"
REASON_NO_PHOTO = "Tidak ada foto reviewer"
REASON_ALL_FIVES = "Detail rating semua 5"
REASON_NEW_REVIEWER = "Reviewer baru (<=2 review)"
REASON_NOT_LOCAL = "Bukan Local Guide"
REASON_NO_CONTEXT = "Konteks review kosong"
REASON_BURST = "Banyak review di hari yg sama (>5)"
REASON_REAL = "Terlihat asli"

# --- fixed values: the labeller's local-guide spellings ----------------------
LOCAL_GUIDE_TRUE_LABELLER = ("True", "true")
# the trainers' spellings, compared after lower-casing
LOCAL_GUIDE_TRUE_TRAINER = ("1", "true", "yes")

# --- fixed values: image-list tokens treated as empty -------------------------
IMAGE_EMPTY_TOKENS = ("nan", "none", "null")

# --- stop words and stems: small samples --------------------------------------
# The reference takes both from a third-party package that is not part of it.
# These samples exist so the operators run end to end; callers pass their own
# tables (any size) to ``remove_stopwords`` / ``stem_tokens``.
STOPWORDS_SAMPLE = (
    "yang", "untuk", "pada", "ke", "para", "namun", "menurut", "antara", "dia", "dua",
    "ia", "seperti", "jika", "sehingga", "kembali", "dan", "tidak", "ini", "karena",
    "kepada", "oleh", "saat", "harus", "sementara", "setelah", "belum", "kami", "sekitar",
    "bagi", "serta", "di", "dari", "telah", "sebagai", "masih", "hal", "ketika", "adalah",
    "itu", "dalam", "bisa", "bahwa", "atau", "hanya", "kita", "dengan", "akan", "juga",
    "ada", "mereka", "sudah", "saya", "terhadap", "secara", "agar", "lain", "anda",
    "begitu", "mengapa", "kenapa", "yaitu", "yakni", "daripada", "itulah", "lagi", "maka",
    "tentang", "demi", "dimana", "kemana", "pula", "sambil", "sebelum", "sesudah", "supaya",
    "guna", "kah", "pun", "sampai", "sedangkan", "selagi", "tetapi", "apakah",
    "kecuali", "sebab", "selain", "seolah", "seraya", "seterusnya", "tanpa", "agak", "boleh",
    "dapat", "dsb", "dst", "dll", "dahulu", "dulunya", "anu", "demikian", "tapi", "ingin",
    "nggak", "mari", "nanti", "melainkan", "oh", "ok", "seharusnya", "sebetulnya",
    "setiap", "setidaknya", "sesuatu", "pasti", "saja", "toh", "ya", "walau", "tolong",
    "tentu", "amat", "apalagi", "bagaimanapun",
)

STEMS_SAMPLE = {
    "makanan": "makan",
    "minuman": "minum",
    "pelayanan": "layan",
    "layanan": "layan",
    "rekomendasi": "rekomendasi",
    "tempatnya": "tempat",
    "makanannya": "makan",
    "harganya": "harga",
    "rasanya": "rasa",
    "pesanan": "pesan",
    "kebersihan": "bersih",
    "keramahan": "ramah",
    "menunggu": "tunggu",
    "datangnya": "datang",
    "pelayannya": "layan",
}

# --- numeric feature names in the order of the feature vector ----------------
BASE_NUMERIC_FEATURES = (
    "text_word_count", "text_char_count", "avg_word_length",
    "exclamation_count", "question_count", "punctuation_count", "uppercase_word_ratio",
    "stars_norm", "has_image", "n_images", "reviewer_count_log", "is_local_guide",
    "detail_rating_all_5", "same_day_count",
    "pattern_5star_short", "pattern_5star_nophoto", "pattern_new_reviewer", "pattern_same_day",
)

TEXT_QUALITY_FEATURES = (
    "tq_vowel_ratio", "tq_abnormal_vowel", "tq_valid_word_ratio", "tq_low_valid_words",
    "tq_avg_word_length", "tq_has_long_words", "tq_entropy", "tq_high_entropy",
    "tq_repeated_ratio", "tq_has_repeated", "tq_consonant_cluster", "tq_long_consonant",
    "tq_gibberish_score", "tq_is_gibberish",
)

NUMERIC_FEATURES = BASE_NUMERIC_FEATURES + TEXT_QUALITY_FEATURES

# the labeller's six numeric columns for its baseline models
LABELLER_NUMERIC_FEATURES = (
    "stars", "reviewernumberofreview", "text_len_words", "has_image_i", "islocalguid_i",
    "same_day_count",
)
