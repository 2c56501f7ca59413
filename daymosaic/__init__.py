"""daymosaic: daily point observations, cleaned, averaged by region and mapped, on Spark."""
