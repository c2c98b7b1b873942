"""Item ids of the bedside recording systems."""

from __future__ import annotations

# Item ids in order of preference. The first one charted in an hour wins.
DIASTOLIC = (220180, 220051, 220060, 225310, 224643, 227242, 228151)
SYSTOLIC = (220179, 220050, 220059, 224167, 225309, 227243, 228152)
EYE = (220739, 226756)
EYE_WIDE = (220739, 227011, 226756)
VERBAL = (223900, 226758)
MOTOR = (223901, 226757)
TEMPERATURE = (223762, 223761)

# Features charted under one id.
HEART_RATE = 220045
RESP_RATE = 220210
SPO2 = 220277
TEMP_F = 223761
TEMP_C = 223762

# Families read item by item.
EASY_VITALS = (220045, 220210, 220277)
GCS_REGULAR = (220739, 223900, 223901)
GCS_APACHE2 = (226756, 226758, 228112, 226757)
GCS_APACHE4 = (227011, 227012, 227014)
OLDER_SYSTEM = (211, 618, 646, 678, 442, 51, 8368)
OLDER_SYSTEM_EXCLUDED_SUBJECTS = (499, 8733, 10273, 14712, 19967, 20861)
LONG_FORM = (
    220179, 220050, 228152, 227243, 225167, 220059, 225309,
    220180, 220051, 228151, 227242, 224643, 220060, 225310,
    220045, 220210, 223761, 220277, 220739, 223900, 223901,
    226756, 226758, 228112, 226757, 227011, 227012, 227014,
)

# Culture specimen ids that count as a suspected infection.
CULTURE_SPECIMENS = (70011, 70012, 70060, 70017, 70076, 70070, 70062, 70079)
ANTIBIOTICS = "Antibiotics"

# The nine vitals of a wide hour, each with its ladder.
WIDE_FEATURES = {
    "bp_dia": DIASTOLIC,
    "bp_sys": SYSTOLIC,
    "heart_rate": (HEART_RATE,),
    "resp_rate": (RESP_RATE,),
    "temp_f": TEMPERATURE,
    "spo2": (SPO2,),
    "eye_opening": EYE,
    "verbal": VERBAL,
    "motor": MOTOR,
}
VITALS = tuple(WIDE_FEATURES)
GCS_PARTS = ("eye_opening", "verbal", "motor")
