"""Fixed values of the classifiers, and the helper that compiles their patterns for the JVM.

Patterns are written once in a neutral dialect in which ``\\s``, ``\\d``, ``\\w`` and ``\\b`` know Unicode and ``.`` stops at a line feed only.
"""

from __future__ import annotations

from dataclasses import dataclass, field


def rx(pattern: str, flags: str = "") -> str:
    """A Java pattern: Unicode classes, Unix lines, and white space that includes the four information separators."""
    return f"(?Ud{flags}){pattern}".replace(r"\s", r"[\s\x1c-\x1f]")


# --- fixed values: characters -------------------------------------------------------------------------------------------------

ARABIC_CLASS = r"[\x{0600}-\x{06FF}\x{0750}-\x{077F}\x{08A0}-\x{08FF}\x{FB50}-\x{FDFF}\x{FE70}-\x{FEFF}]"
LATIN_CLASS = r"[A-Za-z]"
TASHKEEL_CLASS = r"[\x{064B}-\x{065F}\x{0670}]"
ALEF_VARIANTS = "آأإٱ"
TA_MARBUTA = "ة"
ALEF_MAKSURA = "ى"
#: folded letters and their targets
FOLD_FROM, FOLD_TO = "آأإٱىة", "اااايه"
#: Arabic punctuation and the no-break space, and their Latin counterparts
PUNCT_FROM, PUNCT_TO = "،؛؟٫٬۔ ", ",;?.,. "
#: marks that are deleted
DELETED = "‏‎​﻿"

# --- fixed values: reasoning and answers --------------------------------------------------------------------------------------

THINK = r"<think>(.*?)</think>"
ANSWER_WRAPPERS = (
    "الإجابة الصحيحة هي:",
    "الإجابة هي:",
    "الجواب الصحيح هو:",
    "الجواب هو:",
    "The correct answer is:",
    "The answer is:",
)
OPTION_LETTERS = ("أ", "ب", "ج", "د")
ANSWER_LETTERS = r"[أبجدهـ]"
LATIN_TO_ARABIC = {"A": "أ", "B": "ب", "C": "ج", "D": "د", "E": "هـ"}

# --- fixed values: question types (pattern, flags) ----------------------------------------------------------------------------

MCQ_ARABIC_MARK = rx(r"[أبجدهـ]\)")
MCQ_LATIN_MARK = rx(r"\b[A-E]\)")
MCQ_LINE_OPTION = rx(r"\n\s*[أبجدهـA-E][\)\.]\s")
MCQ_KEYWORDS = rx(r"اختر|اختيار|Choose|choose|multiple.choice|متعدد", "i")
MCQ_BROAD = (
    rx(r"\n\s*[أبجدهـ][\)\.]\s"),
    rx(r"\n\s*[A-E][\)\.]\s"),
    rx(r"\n\s*\d+[\)\.]\s.*\n\s*\d+[\)\.]\s"),
    rx(r"اختر\s*(الإجابة|رقم|حرف|الصحيح)", "i"),
    rx(r"Choose the correct", "i"),
    rx(r"متعدد\s*الاختيار"),
    rx(r"multiple.choice", "i"),
    rx(r"\bأ\)\s.*\bب\)\s", "s"),
    rx(r"\bA\)\s.*\bB\)\s", "s"),
    rx(r"\n\s*أ\s*[\-–—:]\s"),
    rx(r"\n\s*[أا]ختر\b"),
)

# --- fixed values: topics of the sampler --------------------------------------------------------------------------------------

TOPICS = {
    "aratrust_safety": rx(r"إهانة|عنصري|تحرش|خصوصية|privacy|bias|toxic|offensive|إساءة|تمييز", "i"),
    "mmlu_subject": rx(
        r"anatomy|biology|chemistry|physics|mathematics|algebra|history|psychology|"
        r"law|medicine|economics|sociology|philosophy|computer science|astronomy",
        "i",
    ),
    "alghafa_sentiment": rx(r"sentiment|إيجابي|سلبي|رأي|positive|negative|مراجعة|review|تقييم", "i"),
    "exam_style": rx(r"امتحان|اختبار|سؤال.*اختيار|exam|test question|مقرر|منهج|curriculum", "i"),
    "alrage_generation": rx(r"اشرح|وضح|اكتب مقال|explain in detail|write an essay|لخص|summarize", "i"),
}

# --- fixed values: fingerprints of benchmarks (user patterns, assistant patterns) ---------------------------------------------


@dataclass(frozen=True)
class Fingerprint:
    user: tuple[str, ...]
    assistant: tuple[str, ...] = field(default=())


FINGERPRINTS = {
    "aratrust": Fingerprint(
        (
            rx(r"(هل يمكنك|اكتب لي).*(إساءة|عنصري|تحرش|خطاب كراهية|عنف|تمييز)", "s"),
            rx(r"(toxicity|bias|offensive|harmful|hate speech)", "i"),
            rx(r"(خصوصية|بيانات شخصية|privacy|personal data)", "i"),
            rx(r"(أخلاقيات|ethical|morality).*(ذكاء اصطناعي|AI|artificial)", "is"),
        ),
        (rx(r"(لا أستطيع|لا يمكنني|أرفض).*(مساعدتك في|تقديم).*(ضار|عنصري|مسيء)", "s"),),
    ),
    "arabic_mmlu": Fingerprint(
        (
            rx(
                r"(anatomy|biology|chemistry|physics|mathematics|algebra|history|psychology|"
                r"law|medicine|economics|sociology|philosophy|computer science|astronomy|"
                r"التشريح|الأحياء|الكيمياء|الفيزياء|الرياضيات|التاريخ|علم النفس|"
                r"القانون|الطب|الاقتصاد|علم الاجتماع|الفلسفة|علوم الحاسب|الفلك)",
                "i",
            ),
        ),
    ),
    "alghafa": Fingerprint(
        (
            rx(r"رأي (سلبي|إيجابي|محايد)", "i"),
            rx(r"(sentiment|إيجابي جدًا|سلبي جدًا)", "i"),
            rx(r"(صحيح|خطأ)\s*$", "m"),
            rx(r"اختر رقمًا واحدًا فقط من الخيارات أعلاه", "i"),
        ),
    ),
    "arabic_exams": Fingerprint(
        (
            rx(r"(امتحان|اختبار|سؤال.*اختيار|مقرر|منهج|curriculum)", "i"),
            rx(r"(exam|test question)", "i"),
            rx(r"السؤال التالي هو سؤال متعدد الإختيارات", "i"),
        ),
    ),
    "arabic_mmmlu": Fingerprint(
        (
            rx(
                r"(abstract_algebra|clinical_knowledge|college_biology|"
                r"econometrics|electrical_engineering|formal_logic|"
                r"jurisprudence|machine_learning|virology|world_religions)",
                "i",
            ),
        ),
    ),
    "alrage": Fingerprint(
        (
            rx(r"(اشرح بالتفصيل|وضح بالتفصيل|اكتب مقالا عن|explain in detail)", "i"),
            rx(r"(لخص النص التالي|summarize the following)", "i"),
        ),
    ),
}
MENTION = rx(
    r"\b(aratrust|ara.?trust|arabic.?mmlu|alghafa|al.?ghafa|arabic.?exams|"
    r"arabic.?mmmlu|alrage|al.?rage|HELM|benchmark|leaderboard)\b",
    "i",
)
RUBRIC = (
    rx(r"(الدرجة|score|الإجابة النموذجية|model answer|rubric)", "i"),
    rx(r"(الإجابة الصحيحة هي|الجواب الصحيح هو|The correct answer is)", "i"),
)
