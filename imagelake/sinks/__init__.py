"""Writers: landing area, request messages, prediction and error logs, model reports."""
