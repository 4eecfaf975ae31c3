"""The five scripted scenarios of the original pipeline, as test fixtures.

Fixed values: the scenario file contents and the arrival time the original
pipeline assigns to each file name pattern (note SOL_5 maps to 12-04).
"""

from __future__ import annotations

import os

# --- fixed values: scenario files (run -> {file name: content}) ------------
SCENARIOS = {
    1: {
        "SOH/SOH_1.json": '{"HID":"H1","HDATE":"2021-12-01","HCUST":"C1","HCUSTNAME":"Charlie"}',
        "SOL/SOL_1.json": '\n{"HID":"H1","LID":"L1","LDATE":"2021-12-01","PROD":"P1","AMT":13}\n'
                          '{"HID":"H1","LID":"L2","LDATE":"2021-12-01","PROD":"P2","AMT":17}\n',
    },
    2: {
        "SOH/SOH_2.json": '{"HID":"29H99","HDATE":"2021-12-02","HCUST":"C2","HCUSTNAME":"Bobby"}',
        "SOL/SOL_2.json": '\n{"HID":"H1","LID":"L3","LDATE":"2021-12-02","PROD":"P3","AMT":24}\n'
                          '{"HID":"H1","LID":"L2","LDATE":"2021-12-02","PROD":"P2","AMT":25}\n',
    },
    3: {
        "SOH/SOH_3.json": "//",
        "SOL/SOL_3.json": '\n{"HID":"29H99","LID":"L4","LDATE":"2021-12-02","PROD":"P5","AMT":35}\n'
                          '{"HID":"3H3333","LID":"L5","LDATE":"2021-12-03","PROD":"P6","AMT":37}\n',
    },
    4: {
        "SOL/SOL_4.json": '\n{"HID":"29H99","LID":"L6","LDATE":"2021-12-04","PROD":"P6","AMT":10}\n'
                          '{"HID":"29H99","LID":"L4","LDATE":"2021-12-04","PROD":"P5","AMT":0}\n'
                          '{"HID":"3H3333","LID":"L5","LDATE":"2021-12-04","PROD":"P6","AMT":0}\n',
    },
    5: {
        "SOH/SOH_5.json": '{"HID":"3H3333","HDATE":"2021-12-05","HCUST":"","HCUSTNAME":"Alfred"}',
    },
}

# --- fixed values: arrival time by source file pattern ----------------------
RECEIVED_RULES = [
    ("%/SOH_1%", "2021-12-01 01:00:00.001001"),
    ("%/SOH_2%", "2021-12-02 02:00:00.002002"),
    ("%/SOH_3%", "2021-12-03 03:00:00.003003"),
    ("%/SOH_4%", "2021-12-04 04:00:00.004004"),
    ("%/SOH_5%", "2021-12-05 04:00:00.004004"),
    ("%/SOL_1%", "2021-12-01 01:01:00.001001"),
    ("%/SOL_2%", "2021-12-02 02:02:00.002002"),
    ("%/SOL_3%", "2021-12-03 03:03:00.003003"),
    ("%/SOL_4%", "2021-12-04 04:04:00.004004"),
    ("%/SOL_5%", "2021-12-04 04:04:00.004004"),
]
# --- end of fixed values ------------------------------------------------------


def drop_scenario(root: str, run: int) -> None:
    """Write the files of one scenario under ``root`` (SOH/, SOL/)."""
    for name, content in SCENARIOS[run].items():
        path = os.path.join(root, name)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w") as f:
            f.write(content)


def make_dirs(root: str) -> tuple[str, str]:
    h, l = os.path.join(root, "SOH"), os.path.join(root, "SOL")
    os.makedirs(h, exist_ok=True)
    os.makedirs(l, exist_ok=True)
    return h, l
