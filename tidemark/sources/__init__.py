"""Sources and sinks: the driver's tables, warehouse views, constants, planning inputs and files written."""
