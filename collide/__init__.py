"""collide: collision-event analytics as Spark DataFrame / SQL plans.

Every operator is a lazy ``f(df, ...) -> DataFrame`` or ``f(col, ...) -> Column``.
Actions happen only in the validation gate, scaler fits, sinks and model fits.
"""

__version__ = "0.1.0"
