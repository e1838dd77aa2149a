"""Tables of the rig log: schemas, defaults and the board's register and mask catalogues."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Schemas of the logs, as DDL.
EVENTS = "session_id string, seq bigint, t_seconds double, t timestamp, address int, message_type string, payload array<double>, value bigint, chunk timestamp"
VIDEO_CSV = "Time double, hw_counter bigint, hw_timestamp double"
ROI = "session_id string, t_seconds double, region int, activity double"
STRIPS = "session_id string, t_seconds double, y int, pixels array<int>"
RULES = "session_id string, t_seconds double, rule_alias string, sample_with_replacement boolean, transitions map<string,array<string>>"

#: Defaults of session settings, in the units of the settings file.
SESSION_DEFAULTS = {
    "chargeTime": 0.2,
    "minimumPokeTime": 0.01,
    "maximumPokeTime": 10.0,
    "robocopyTimeInterval": 3600.0,
    "maxVideoLength": 120.0,
    "minOdorDelivery": 0.1,
    "maxOdorDelivery": 8.0,
    "switchTime1": 0.01,
    "switchTime2": 0.02,
    "vacuumDelay": 0.025,
    "portValveCycleTime": 0.025,
    "vacuumDuration": 0.07,
    "useVacuum": True,
}
CAMERA_DEFAULTS = {"preEventTime": 2.5, "postEventTime": 2.5}
DEFAULT_STATE = "DefaultState"

#: Registers of the board, by address (name, type, length, mask).
AUX_IN, OUT_SET, OUT_CLEAR, OUT_TOGGLE, OUT_STATE, PWM_RISE, SESSION_END = 32, 35, 36, 37, 38, 68, 88
_SINGLE = (
    (32, "AuxInState", "U8", 1, "AuxiliaryInputs"),
    (33, "AuxInRisingEdge", "U8", 1, "AuxiliaryInputs"),
    (34, "AuxInFallingEdge", "U8", 1, "AuxiliaryInputs"),
    (35, "OutputSet", "U16", 1, "DigitalOutputs"),
    (36, "OutputClear", "U16", 1, "DigitalOutputs"),
    (37, "OutputToggle", "U16", 1, "DigitalOutputs"),
    (38, "OutputState", "U16", 1, "DigitalOutputs"),
    (39, "PwmAndStimEnable", "U16", 1, "PwmAndStimMappings"),
    (40, "PwmAndStimDisable", "U16", 1, "PwmAndStimMappings"),
    (41, "PwmAndStimState", "U16", 1, "PwmAndStimMappings"),
    (66, "PwmStart", "U8", 1, "PwmChannels"),
    (67, "PwmStop", "U8", 1, "PwmChannels"),
    (68, "PwmRiseEvent", "U8", 1, "PwmChannels"),
    (69, "Stim0PulseOnTime", "U16", 1, None),
    (70, "Stim0PulseOffTime", "U16", 1, None),
    (71, "Stim0PulseCount", "U16", 1, None),
    (72, "Stim0AcquisitionMode", "U8", 1, "AcquisitionMode"),
    (73, "Stim0TriggerSource", "U8", 1, "TriggerSource"),
    (74, "StimStart", "U8", 1, "StimChannels"),
    (75, "StimStop", "U8", 1, "StimChannels"),
    (76, "OutputPulse", "U16", 1, "DigitalOutputs"),
    (87, "ExpansionBoard", "U8", 1, "ExpansionBoardType"),
    (90, "MagneticEncoder", "U16", 2, None),
    (91, "MagneticEncoderSampleRate", "U8", 1, "MagneticEncoderSampleRateMode"),
    (94, "ServoPeriod", "U16", 1, None),
    (100, "OpticalFlow", "S16", 3, None),
)
_PWM = (("Frequency", "Float", None), ("DutyCycle", "Float", None), ("PulseCount", "U16", None), ("ActualFrequency", "Float", None), ("ActualDutyCycle", "Float", None), ("AcquisitionMode", "U8", "AcquisitionMode"), ("TriggerSource", "U8", "TriggerSource"), ("EventConfig", "U8", "EnableFlag"))
REGISTERS = sorted(
    [
        *_SINGLE,
        *((42 + 8 * c + i, f"Pwm{c}{name}", kind, 1, mask) for c in range(3) for i, (name, kind, mask) in enumerate(_PWM)),
        *((77 + i, f"Out{i}PulseWidth", "U16", 1, None) for i in range(10)),
        *((95 + i, f"Servo{i}PulseWidth", "U16", 1, None) for i in range(3)),
    ]
)
#: Names of the parts of payloads of more than one value.
PAYLOAD_PARTS = {"MagneticEncoder": ("Angle", "Magnitude"), "OpticalFlow": ("DeltaX", "DeltaY", "Squal")}

#: Names of the bits of masks.
BIT_MASKS = {
    "AuxiliaryInputs": {"Aux0": 0x1, "Aux1": 0x2, "Aux0Changed": 0x10, "Aux1Changed": 0x20},
    "DigitalOutputs": {f"Out{i}": 1 << i for i in range(10)},
    "PwmAndStimMappings": {"Pwm0ToOut1": 0x1, "Pwm0ToOut2": 0x2, "Pwm0ToOut3": 0x4, "Pwm1ToOut6": 0x8, "Pwm1ToOut7": 0x10, "Pwm1ToOut8": 0x20, "Pwm2ToOut9": 0x40, "Stim0ToOut0": 0x80, "Stim0ToOut5": 0x100},
    "PwmChannels": {"Pwm0": 0x1, "Pwm1": 0x2, "Pwm2": 0x4},
    "StimChannels": {"Stim0": 0x1},
}
#: Names of the values of groups.
GROUP_MASKS = {
    "AcquisitionMode": {"Continuous": 0, "Finite": 1},
    "TriggerSource": {"Software": 0, "Aux0Rising": 1, "Aux0Falling": 2, "Aux0WhileHigh": 3, "Aux0WhileLow": 4, "Aux1Rising": 16, "Aux1Falling": 32, "Aux1WhileHigh": 64, "Aux1WhileLow": 128},
    "ExpansionBoardType": {"Breakout": 0, "MagneticEncoder": 1, "ServoMotor1": 2, "ServoMotor2": 3, "ServoMotor3": 4, "OpticalFlow": 5},
    "MagneticEncoderSampleRateMode": {"SampleRate50Hz": 0, "SampleRate100Hz": 1, "SampleRate200Hz": 2, "SampleRate250Hz": 3, "SampleRate500Hz": 4, "SampleRate1000Hz": 5},
}


def register_dim(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(REGISTERS, "address int, name string, type string, length int, mask_type string")


def mask_dim(spark: SparkSession, masks: dict) -> DataFrame:
    return spark.createDataFrame([(m, n, v) for m, names in masks.items() for n, v in names.items()], "mask string, name string, value int")
