"""A feed made from the timetable: calibration, delayed runs, vehicles, and polls."""
