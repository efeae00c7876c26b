"""Clinical codes and the column names of the flattened bundle.

Fixed values: these must equal the codes and names the products are defined
on, so they are listed plainly and together.
"""

from __future__ import annotations

# --- fixed values: clinical codes -------------------------------------------
SESSION = "1158"  # observation code of an exercise session
DISORIENTATION = "62476001"  # flag
ABNORMAL_VISION = "7973008"  # flag
DIZZINESS = "404640003"  # flag
HEADACHE = "25064002"  # flag
RANGE_OF_MOVEMENT = "404979006"  # sampled signal
SPEED_OF_MOVEMENT = "282108002"  # sampled signal
REPETITIONS = "1202026006"  # quantity
DURATION = "228450008"  # quantity
SESSION_SCORE = "89191-1"  # quantity

# --- fixed values: flattened column names (path joined by "_") ---------------
REFERENCE = "entry_resource_subject_reference"
EFFECTIVE = "entry_resource_effectiveDateTime"
SESSION_CODE = "entry_resource_code_coding_code"
DISPLAY = "entry_resource_code_coding_display"
COMPONENT_CODE = "entry_resource_component_code_coding_code"
TEXT = "entry_resource_component_code_text"
FLAG = "entry_resource_component_valueBoolean"
QUANTITY = "entry_resource_component_valueQuantity_value"
SAMPLES = "entry_resource_component_valueSampledData_data"
SAMPLE_TIMES = "entry_resource_component_valueSampledData_extension_valueString"

# --- fixed values: derived columns -------------------------------------------
PATIENT = "Patient_id"
DATE = "Date"
WEEK = "Week"
START = "Start_time"

# Symptom flags: code -> the name of the Yes/No column.
SYMPTOMS = {
    DISORIENTATION: "Disorientation",
    ABNORMAL_VISION: "Abnormal Vision",
    DIZZINESS: "Dizziness",
    HEADACHE: "Headache",
}

# Sampled measures by short name.
MEASURES = {"range": RANGE_OF_MOVEMENT, "speed": SPEED_OF_MOVEMENT}

# Fixed 15-second segments of the first minute, closed at both ends.
SEGMENTS = ((0, 15), (15, 30), (30, 45), (45, 60))
