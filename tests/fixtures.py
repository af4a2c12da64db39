"""Generated episode trees (the reference ships only metadata, no state logs)."""

from __future__ import annotations

import json
import os

# Golden metadata rows of the four recorded episodes (values as recorded).
GOLDEN_META = [
    # date, task, path id, key used for the index, index, start_time, end_time, frames
    ("20250919", "shred_scrap_paper", "000775", "episode_index", 775, 1749176386.6180475, 1749176419.846028, 984),
    ("20250919", "pour_fries_into_plate", "001533", "episode_index", 1533, 1754635890.58, 1754635926.8799915, 1100),
    ("20250919", "press_three_buttons", "FFFFFF", "episode_idx", 80, 1758683625.4170816, 1758683646.7130156, 639),
    ("20250919", "arrange_paper_cups", "000772", "episode_index", 772, 1753167772.4184952, 1753167832.2461429, 1782),
]
ROBOT_OF_TASK = {"shred_scrap_paper": "ur5", "pour_fries_into_plate": "aloha",
                 "press_three_buttons": "franka", "arrange_paper_cups": "arx5"}
VIDEO_FILES = {
    "aloha": ["cam_wrist_left_rgb.mp4", "cam_wrist_right_rgb.mp4", "cam_high_rgb.mp4"],
    "arx5": ["arm_realsense_rgb.mp4", "global_realsense_rgb.mp4", "right_realsense_rgb.mp4"],
    "ur5": ["handeye_realsense_rgb.mp4", "global_realsense_rgb.mp4"],
    "franka": ["handeye_realsense_rgb.mp4", "main_realsense_rgb.mp4"],   # side camera missing on purpose
}


def _state_line(robot: str, i: int, dof: int, pos: int, bad_pose: bool = False) -> str:
    joint = [float(i)] + [round(0.01 * k + 0.001 * i, 6) for k in range(1, dof)]
    pose = [round(0.1 * k, 3) for k in range(pos - (1 if bad_pose else 0))]
    if robot == "aloha":
        rec = {"joint_positions": joint, "gripper": 0.5, "ee_pose_rpy": pose}
    elif robot == "arx5":
        rec = {"joint_positions": joint, "gripper_width": 0.04, "end_effector_pose": pose}
    elif robot == "ur5":
        rec = {"joint_positions": joint, "gripper": 0.3, "ee_positions": pose}
    else:
        rec = {"joint_positions": joint, "gripper_width": 0.02, "ee_positions": pose}
    return json.dumps(rec)


def make_episode_tree(root: str) -> dict:
    """Write the four episodes with state logs and dummy videos.

    Cases: >1,000 lines (arrange_paper_cups); aloha left/right of unequal
    length with a blank last line; a corrupt line (ur5 line 5); a wrong-length
    pose (franka line 3); a missing camera (franka side).
    """
    dims = {"aloha": (6, 16), "arx5": (6, 6), "ur5": (6, 6), "franka": (7, 7)}
    for date, task, pid, key, idx, st, et, frames in GOLDEN_META:
        ep = os.path.join(root, date, task, "data", f"episode_{pid}")
        for sub in ("meta", "states", "videos"):
            os.makedirs(os.path.join(ep, sub), exist_ok=True)
        with open(os.path.join(ep, "meta", "episode_meta.json"), "w") as f:
            json.dump({key: idx, "start_time": st, "end_time": et, "frames": frames}, f, indent=4)
        robot = ROBOT_OF_TASK[task]
        dof, pos = dims[robot]
        if robot == "aloha":
            for arm, n in (("left", 40), ("right", 37)):
                with open(os.path.join(ep, "states", f"{arm}_states.jsonl"), "w") as f:
                    f.write("\n".join(_state_line(robot, i, dof, pos) for i in range(n)) + "\n")
        else:
            n = 1100 if task == "arrange_paper_cups" else 30
            lines = []
            for i in range(n):
                if robot == "ur5" and i == 5:
                    lines.append("{not json")
                else:
                    lines.append(_state_line(robot, i, dof, pos, bad_pose=(robot == "franka" and i == 3)))
            with open(os.path.join(ep, "states", "states.jsonl"), "w") as f:
                f.write("\n".join(lines) + "\n")
        for v in VIDEO_FILES[robot]:
            with open(os.path.join(ep, "videos", v), "wb") as f:
                f.write(b"\x00\x00\x00\x18ftypmp42" + bytes(64))
    return {"root": root}
