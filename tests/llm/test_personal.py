import pytest
from pyspark.sql import functions as F

from ledgerloom.llm.personal import find, folded, occurrences, redact


def spans(text):
    return {(kind, text[a:b]) for kind, a, b in find(text)}


@pytest.mark.parametrize(
    "text, want",
    [
        ("Write to ann.lee+x@mail.example.com.", {("EMAIL", "ann.lee+x@mail.example.com")}),
        ("ann (at) care [dot] example, please", {("EMAIL", "ann (at) care [dot] example")}),
        ("mail ann_lee at wing-b dot invalid now", {("EMAIL", "ann_lee at wing-b dot invalid")}),
        ("ann @ care.example", {("EMAIL", "ann @ care.example")}),
        ("联系电话：+16195550158。", {("PHONE", "+16195550158")}),
        ("Call (310) 555-0185 or 1-602-555-0183 ext. 160", {("PHONE", "(310) 555-0185"), ("PHONE", "1-602-555-0183")}),
        ("at 640 – 555 – 0122 or 926/555-0139 or 001 946 555 0189", {("PHONE", "640 – 555 – 0122"), ("PHONE", "926/555-0139"), ("PHONE", "001 946 555 0189")}),
        ("((930) 555-0160)", {("PHONE", "(930) 555-0160")}),
        ("SSN: 931–40–2740 and soc sec # 980.20.3483", {("ID_NUMBER", "931–40–2740"), ("ID_NUMBER", "980.20.3483")}),
        ("Medicare number 1B48-YG7-PD04, MBI 4o12re3eq03", {("ID_NUMBER", "1B48-YG7-PD04"), ("ID_NUMBER", "4o12re3eq03")}),
        ("MRN A4656477; chart no. of the patient 7-8288-144", {("ID_NUMBER", "A4656477"), ("ID_NUMBER", "7-8288-144")}),
        ("driver's license Z655 6045 9310", {("ID_NUMBER", "Z655 6045 9310")}),
        ("lives at 7456 Old Mill Ct, Suite 19\nDruven, AZ 85266-3988.", {("ADDRESS", "7456 Old Mill Ct, Suite 19\nDruven, AZ 85266-3988")}),
        ("went to 5394 Quarrow St. The nurse in charge", {("ADDRESS", "5394 Quarrow St")}),
        ("went to P. O. BOX 5380 Apt. 181 Drumoowe, VA 30987.", {("ADDRESS", "P. O. BOX 5380 Apt. 181 Drumoowe, VA 30987")}),
        ("at Calle Larkmoor 9448, Unit 53 was", {("ADDRESS", "Calle Larkmoor 9448, Unit 53")}),
        ("5686 County Road 15\nTolvenard, OR 26345", {("ADDRESS", "5686 County Road 15\nTolvenard, OR 26345")}),
        ("I spoke with Dr. Zanvane and with Ms. Petra Calthorpe about", {("NAME", "Zanvane"), ("NAME", "Petra Calthorpe")}),
        ("The aide, Quorist, Mei, left", {("NAME", "Quorist, Mei")}),
        ("La hija, Ulric T. Vasmark, pidió", {("NAME", "Ulric T. Vasmark")}),
        ("the form listed linnea stoñano with", {("NAME", "linnea stoñano")}),
        ("Signed: MEI O'STOMARK, 8/14/2024", {("NAME", "MEI O'STOMARK")}),
        ("İİ Ⅳ Dr. Zanvane said", {("NAME", "Zanvane")}),
    ],
)
def test_found(text, want):
    assert spans(text) == want


@pytest.mark.parametrize(
    "text",
    [
        "Lot L8468-29-0077 and order 5474-0077-12, invoice 2023-456-8763, case C4602721079.",
        "The Grace Room and the Paul Street entrance were being painted at Larkmoor Wing.",
        "The nurse in charge could not say when; room 386-B, CCN 80B177, 0000000000.",
        "Unit 3 West stayed silent at 11:00 AM. Dr",
        "2024-03-01 10:15, $195,816, 146/83, Resident #106",
        "  \n\t",
        "",
    ],
)
def test_nothing_found(text):
    assert find(text) == []


def test_redaction_leaves_the_rest():
    assert redact("Dr. Zanvane, x@y.example!") == "Dr. [NAME], [EMAIL]!"
    assert redact("plain") == "plain" and redact("") == "" and redact(None) is None


def test_folding_keeps_positions():
    assert len(folded("İstanbul ŞÇ")) == len("İstanbul ŞÇ")


def test_long_text_and_frame(spark):
    long = "word " * 50_000 + "x@y.example " + "9" * 50_000 + " " + "a" * 50_000 + "@"
    rows = [(1, None), (2, ""), (3, long), (4, "x@y.example"), (4, "x@y.example"), (None, "Dr. Zanvane")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("pii_type", F.lit("clash"))
    got = sorted((r["doc_id"] or 0, r["pii_type"], r["start_pos"], r["end_pos"]) for r in occurrences(df, "doc_id", "text").collect())
    assert got == [(0, "NAME", 4, 11), (3, "EMAIL", 250_000, 250_011), (4, "EMAIL", 0, 11), (4, "EMAIL", 0, 11)]
    assert occurrences(df.limit(0), "doc_id", "text").count() == 0
