"""gristmill.plans"""
