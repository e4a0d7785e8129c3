"""Chat prompts as columns: one array of (role, content) per note or lead."""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F

from leadgrade.functions.scoring import literal_map

# --- Fixed values: classification instruction and labelled examples ---
CLASSIFY_INSTRUCTION = (
    "You are a sales-operations assistant that classifies the attitude "
    "expressed in a sales-rep interaction note. The note can be in Turkish, "
    "English, or a mix of the two (code-switching is common). Pick exactly "
    "one of these four labels:\n"
    '- "positive_engagement": the lead is engaged, asks follow-up questions, '
    "or expresses concrete interest.\n"
    '- "objection": the lead raises a concern or doubt about price, '
    "duration, scope, or content.\n"
    '- "neutral": the note is informational with no strong sentiment in '
    "either direction.\n"
    '- "disengaged": the lead is silent, distant, or unresponsive after '
    "outreach.\n"
    "Respond with strict JSON only, no prose, no markdown fences. Schema: "
    '{"attitude": "<one of the four labels>"}. '
    "Choose the single best label even if the note is ambiguous."
)
EXAMPLES: tuple[tuple[str, str], ...] = (
    (
        "Lead webinar sonrası iletişime geçti, demo talep etti ve takım "
        "üyeleriyle birlikte deneyebilmek için ek erişim sordu.",
        "positive_engagement",
    ),
    (
        "After the intro call the lead asked for a tailored pricing sheet "
        "and offered two slots next week to bring in their data team.",
        "positive_engagement",
    ),
    (
        "Fiyatlandırmayı yüksek buldu ve mevcut çözümlerine kıyasla "
        "geri dönüş süresinin nasıl olacağını sorguladı.",
        "objection",
    ),
    (
        "The lead pushed back on the contract length and was not "
        "comfortable with the proposed onboarding scope.",
        "objection",
    ),
    (
        "Görüşmede ürün özelliklerine dair bilgilendirme yapıldı, lead "
        "notları aldı fakat sonraki adım belirtmedi.",
        "neutral",
    ),
    (
        "Shared the standard product overview deck; the lead noted the "
        "information and did not signal a clear next step either way.",
        "neutral",
    ),
    (
        "Üç farklı kanaldan ulaşma denemesine rağmen geri dönüş alınamadı, "
        "son etkileşim üzerinden iki haftadan fazla geçti.",
        "disengaged",
    ),
    (
        "The lead has been silent across the last three follow-up attempts "
        "and has not opened the most recent emails.",
        "disengaged",
    ),
)

# --- Fixed values: note-writing instruction, template, tone and language hints ---
WRITE_INSTRUCTION = """Sen bir B2B/edu satış temsilcisinin CRM notlarını yazıyorsun.
Görev: SADECE 1–3 cümlelik gerçekçi bir etkileşim notu üret (e-posta özeti veya
arama notu tonunda).

KESİN KURALLAR:
1. Verilen tutum sınıfının İSMİNİ ya da eş anlamlısını ASLA yazma
   (örn. 'positive_engagement', 'olumlu yaklaşım', 'objection', 'itiraz var',
   'disengaged', 'mesafeli' gibi etiket ifadeleri kullanma). Tutum YALNIZ
   içerikten/tondan anlaşılmalı.
2. Sonucu ifşa eden ifadeleri YASAK kullan:
   Türkçe: 'sözleşme imzalandı', 'müşteri oldu', 'satın aldı', 'kaydoldu',
   'abone oldu', 'iptal etti', 'vazgeçti', 'kazanıldı', 'kaybedildi'.
   İngilizce: 'closed won', 'closed lost', 'signed up', 'purchased',
   'subscribed', 'churned', 'cancelled', 'converted', 'won the deal'.
   Not KARAR ÖNCESİ etkileşimi yansıtmalı, karar SONRASI sonucu değil.
3. Lead adı/şirket adı uydurma; "Lead", "müşteri adayı", "the lead" gibi genel
   referanslar veya isimsiz aktif cümleler kullan.
4. Doğal, kısa CRM tonu. Tek paragraf. Madde işareti veya başlık kullanma.
5. Açıklama, başlık veya parantez içi not EKLEME — sadece notun kendisi.
"""
WRITE_TEMPLATE = """Tutum sınıfı (yalnız sana yönelik tonlama ipucu, NOT İÇİNDE
asla geçmeyecek): {attitude}
Tonlama ipucu: {tone_hint}

Etkileşim bağlamı (nötr, sonuç sızdırmaz):
- Lead kaynağı: {lead_source}
- Uzmanlık alanı: {specialization}
- Meslek: {occupation}
- Son aktivite: {last_activity}
- Site ziyaret süresi (kategori): {time_bucket}

Dil yönergesi: {language_instruction}

Şimdi sadece notu yaz."""
TONE_HINTS = {
    "positive_engagement": (
        "Lead ilgili, sorular soruyor, takip/demo istiyor. Sıcak ama gerçekçi."
    ),
    "objection": (
        "Lead itiraz/şüphe gösteriyor (fiyat, süre, içerik, zamanlama). "
        "Diyalog açık ama temkinli."
    ),
    "disengaged": (
        "Lead kısa, mesafeli, geri dönüş yapmıyor veya ilgilenmiyor gibi. "
        "Sonuç DEĞİL, mevcut etkileşimin soğukluğu yansıtılır."
    ),
    "neutral": "Bilgilendirici, ne olumlu ne olumsuz. Standart bir takip notu.",
}
LANGUAGE_HINTS = {
    "tr": "Notu TAMAMEN Türkçe yaz.",
    "en": "Write the note entirely in English.",
    "mix": (
        "Notu Türkçe-İngilizce karışık (code-switching) yaz; CRM jargonu "
        "doğal olduğu yerde İngilizce kalsın "
        "('demo', 'pricing', 'follow-up', 'pipeline' vb.), gövde Türkçe olabilir."
    ),
}


def _message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def label_reply(label: str) -> str:
    return json.dumps({"attitude": label})


def classify_messages(text: Column) -> Column:
    """Instruction, eight labelled turns, then the note."""
    shots = [
        _message(role, F.lit(content))
        for note, label in EXAMPLES
        for role, content in (("user", note), ("assistant", label_reply(label)))
    ]
    return F.array(
        _message("system", F.lit(CLASSIFY_INSTRUCTION)), *shots, _message("user", text)
    )


def write_messages(attitude: Column, language: Column, context: Column) -> Column:
    """Instruction plus the template filled from a neutral-context struct.

    The template is cut at its fields and concatenated, so a value that happens
    to contain a field name is not substituted again.
    """
    fields = {
        "attitude": attitude,
        "tone_hint": F.try_element_at(literal_map(TONE_HINTS), attitude),
        "language_instruction": F.try_element_at(literal_map(LANGUAGE_HINTS), language),
        **{
            name: context[name]
            for name in (
                "lead_source",
                "specialization",
                "occupation",
                "last_activity",
                "time_bucket",
            )
        },
    }
    parts: list[Column] = []
    for piece in WRITE_TEMPLATE.split("{"):
        if "}" in piece:
            name, rest = piece.split("}", 1)
            parts += [fields[name], F.lit(rest)]
        else:
            parts.append(F.lit(piece))
    user = F.concat(*parts)
    return F.array(
        _message("system", F.lit(WRITE_INSTRUCTION)), _message("user", user)
    )
