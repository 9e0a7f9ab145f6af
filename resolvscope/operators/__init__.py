"""Report operators: functions from DataFrame to DataFrame."""
