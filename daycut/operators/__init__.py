"""Row and DataFrame operators: flatten/project, interval clip/split, daily
aggregation blocks and calendar-dense joins."""
