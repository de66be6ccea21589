"""ratewise: review analytics and recommendation as Spark DataFrame jobs.

Every operator takes and returns a DataFrame (chain them with ``DataFrame.transform``);
nothing data-sized is collected to the driver.
"""

__version__ = "0.1.0"
