"""Phrase families, category groups and category synonyms."""

from dataclasses import dataclass


@dataclass(frozen=True)
class Lexicon:
    legal: tuple
    churn: tuple
    billing_strong: tuple
    billing_context: tuple
    technical_strong: tuple
    technical_context: tuple
    repetition: tuple
    unresolved: tuple
    frustration: tuple
    clarification: tuple
    billing_action: tuple
    tech_action: tuple
    billing_categories: tuple
    technical_categories: tuple


# The phrases and groups the signals are defined by.
TELECOM_TR = Lexicon(
    legal=("dava", "avukat", "yasal islem", "btk", "tuketici hakem", "cimer", "mahkeme", "icra"),
    churn=(
        "iptal", "kapatacagim", "hattimi tasiyacagim", "baska operator", "sozlesmeyi sonlandir",
        "aboneligimi iptal", "numarami tasiyacagim",
    ),
    billing_strong=(
        "fazla ucret", "beklenmeyen ucret", "haksiz ucret", "iade", "fazla faturalandirma", "mukerrer",
        "paket uyusmazligi", "taahhut bedeli",
    ),
    billing_context=("fatura", "ucret", "taahhut", "paket"),
    technical_strong=(
        "internet yok", "sinyal yok", "baglanti yok", "sebeke yok", "servis yok", "kopuyor", "modem ariz",
        "teknik ariza",
    ),
    technical_context=(
        "cekmiyor", "yavas internet", "mobil veri", "dns", "modem", "baglanti", "sebeke", "kapsama",
        "arama yapamiyorum",
    ),
    repetition=(
        "daha once denedim", "bunu daha once denedim", "ucuncu kez", "ikinci kez", "tekrar", "defalarca",
        "ayni sorun",
    ),
    unresolved=("hala devam ediyor", "cozulmedi", "bir sey degismedi", "sonuc alamadim"),
    frustration=(
        "vaktimi bosa harciyorsunuz", "kabul edilemez", "magdur", "yeter artik", "biktim", "rezalet",
        "sikayetciyim", "anlamiyor musunuz", "kac kere soyledim",
    ),
    clarification=(
        "anlayamadim", "tekrar eder misiniz", "biraz daha aciklar misiniz", "hangi konuda", "tam olarak",
        "detay verir misiniz", "kontrol edebilmem icin",
    ),
    billing_action=("fatura", "ucret", "iade", "hesabinizda gerekli duzeltme", "bir sonraki faturaniza"),
    tech_action=("modem", "sinyal", "sebeke", "teknisyen", "baglanti", "yeniden baslat", "teknik ekip"),
    billing_categories=("billing", "roaming"),
    technical_categories=(
        "data", "coverage", "connectivity", "speed", "voice", "equipment", "installation", "sim_device",
    ),
)

# Knowledge-base words a complaint category stands for.
CATEGORY_SYNONYMS = {
    "billing": ("faturalandirma", "fatura", "ucret", "odeme", "iade"),
    "data": ("mobil internet", "mobil veri", "internet"),
    "coverage": ("kapsama", "sinyal", "cekim"),
    "voice": ("ses", "arama"),
    "connectivity": ("baglanti",),
    "speed": ("hiz", "yavas internet"),
    "sim_device": ("sim", "cihaz"),
    "equipment": ("donanim", "modem", "cihaz"),
    "roaming": ("roaming", "yurtdisi"),
    "installation": ("kurulum",),
}
