"""tunelake: Spark-native batch analytics for music catalogue, daily-chart and
lyrics data.

Every operator is a ``DataFrame -> DataFrame`` function whose column names are
parameters (the music names are the defaults), so the same code runs on the
music zones and on any table that plays their role.
"""

__version__ = "0.1.0"
